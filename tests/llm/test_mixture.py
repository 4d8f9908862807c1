"""The mix against its SQL and against plain water-filling."""

import duckdb
import pytest

from tillroll.llm.mixture import ORACLE, mix_sources, targets

from tests.llm.edge_rows import documents, empty


def by_sql(df):
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "source").toArrow())
    return sorted(con.sql(ORACLE).fetchall(), key=str)


def mixed(df):
    return sorted(((r.doc_id, r.size, r.source_size, r.target, r.size * r.repeats) for r in mix_sources(df).collect()), key=str)


def test_edge_rows(spark):
    assert mixed(documents(spark)) == by_sql(documents(spark))
    assert mix_sources(empty(spark)).collect() == []
    blank = documents(spark).filter("doc_id < 4")
    assert [(r[1], r[3], r[4]) for r in mixed(blank)] == [(0, 0.0, 0)] * 3


def test_near_targets_and_steady(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mix_sources(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mix_sources(docs.repartition(7)).collect()))
    taken, target, size = {}, {}, {}
    for r in rows:
        assert 0 <= r.repeats <= 3
        taken[r.source] = taken.get(r.source, 0) + r.size * r.repeats
        target[r.source], size[r.source] = r.target, r.source_size
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s in taken:
        assert abs(taken[s] - target[s]) <= 0.03 * target[s]


def test_water_level(spark):
    sizes = {"a": 10, "b": 1000, "c": 1000, "d": 1, "e": 0, "é": 500, None: 300}
    rows = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    weight = dict(zip(["a", "b", "c", "d", "e", "é", None], [5, 2, 1] * 3))
    want, free = {}, dict(weight)
    while True:
        left = sum(sizes.values()) - sum(want.values())
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            want.update(share)
            break
        for s in over:
            want[s] = 3 * sizes[s]
            del free[s]
    assert {r.source: r.weight for r in rows} == weight
    assert {r.source: r.target for r in rows} == pytest.approx(want)


@pytest.mark.parametrize("ids", ["half null", "two ids", "one row", "no words"])
def test_repeated_and_null_ids_come_near_the_targets(spark, ids):
    """No document or group of alike rows may draw a source away from its target."""
    rows = []
    for k in range(400):
        i = {"half null": None if k % 2 else k, "two ids": k % 2, "one row": 7, "no words": k % 3}[ids]
        text = "" if ids == "no words" and k % 5 else "same words here" if ids == "one row" else " ".join(["w"] * (k % 9 + 1)) + f" {k}"
        rows.append((i, text, ["a", "b", "c", None][k % 4]))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    assert mixed(df) == by_sql(df)
    taken, target, largest = {}, {}, 0
    for r in mix_sources(df).collect():
        assert 0 <= r.repeats <= 3
        taken[r.source] = taken.get(r.source, 0) + r.size * r.repeats
        target[r.source], largest = r.target, max(largest, r.size)
    assert all(abs(taken[s] - target[s]) <= largest for s in taken), (taken, target)
