"""First copies merged batch by batch against one load of everything."""

import os
import random
import tempfile
from datetime import date

import pytest

from tests.fixtures import make_raw
from tests.test_sources import _row, _write
from tillroll.operators import clean as C
from tillroll.streaming import firsts as firsts_module
from tillroll.streaming.firsts import FirstCopies
from tillroll.streaming.increments import ingest_available, new_files, read_ingested


def _folder():
    return tempfile.mkdtemp(prefix="tillroll-test-")


def _rows(firsts):
    return sorted((str(r.order_id), r.return_flag, r.quantity, r.is_first) for r in firsts.collect())


def _raw(spark, rows):
    """make_raw numbers rows from 0: here each carries its own place."""
    data = make_raw(spark, [dict(order_id=o, return_flag=f, quantity=q) for o, f, q in rows])
    from pyspark.sql import functions as F
    return data.withColumn("row_seq", F.struct(F.col("quantity").cast("long").alias("pos")))


def test_batches_in_any_order_equal_one_load(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, *(f"O{k}" for k in range(60))]), rng.choice(["No", "No", "Yes", "?"]), q) for q in range(400)]
    want = _rows(C.first_copies(_raw(spark, rows)))
    batches = [rows[k::5] for k in range(5)]
    rng.shuffle(batches)
    merged = FirstCopies(spark, _folder(), buckets=7)
    for k, batch in enumerate(batches):
        merged.merge(_raw(spark, batch), f"b{k}")
    assert _rows(merged.read()) == want
    assert merged.merge(_raw(spark, batches[0]), "again").buckets == set()  # nothing new: no bucket is written
    assert merged.merge(_raw(spark, batches[1]), "again") == (set(), set())  # the same commit
    assert _rows(merged.read()) == want


def test_untouched_buckets_keep_their_files(spark):
    merged = FirstCopies(spark, _folder(), buckets=16)
    merged.merge(_raw(spark, [(f"O{k}", "No", k) for k in range(200)]), "one")
    before = merged._folders()
    late = _raw(spark, [("O7", "No", 5000), ("O8", "Yes", 5001), ("N1", "No", 5002)])     # two late copies, one new order
    changed, days = merged.merge(late, "two")
    assert days == {date(2026, 6, 22)}
    after = merged._folders()
    assert len(changed) == 1 and {k for k in after if before.get(k) != after[k]} == changed
    assert merged.read().count() == 201
    assert merged.merge(_raw(spark, [("O9", "No", -1)]), "three").days                    # an earlier copy wins
    assert {r.order_id: r.quantity for r in merged.read().collect()}["O9"] == -1


def test_stream_reads_names_only_and_merges(spark):
    base = _folder()
    drop = os.path.join(base, "drop")
    os.makedirs(drop)
    _write(drop, "sales_2026_06_24.csv", [_row("A", qty=1), _row("B", qty=2, name="two\nlines")])
    _write(drop, "sales_2026_06_25.csv", [_row("A", qty=3), _row("C", qty=4)])
    firsts = FirstCopies(spark, os.path.join(base, "firsts"), buckets=4)
    table, check, ledger = (os.path.join(base, x) for x in ("table", "ckpt", "ledger"))
    ingest_available(spark, drop, table, check, firsts=firsts, ledger=ledger).awaitTermination()
    _write(drop, "sales_2026_06_23.csv", [_row("C", qty=9, flag="Yes"), _row("D", qty=5)])      # arrives late, sorts first
    ingest_available(spark, drop, table, check, firsts=firsts, ledger=ledger).awaitTermination()
    got = {r.order_id: (r.quantity, r.customer_name) for r in C.first_rows(firsts.read()).collect()}
    assert got == {"A": (1, "Shop"), "B": (2, "two\nlines"), "C": (9, "Shop"), "D": (5, "Shop")}
    assert {r.order_id: r.quantity for r in C.first_kept_rows(firsts.read()).collect()} == {"A": 1, "B": 2, "C": 4, "D": 5}
    assert _rows(firsts.read()) == _rows(C.first_copies(read_ingested(spark, table)))
    ranges = {r.file.rsplit("/", 1)[1]: r.rows for r in spark.read.parquet(f"{ledger}/ranges").collect()}
    assert ranges == {f"sales_2026_06_{k}.csv": 2 for k in (23, 24, 25)}
    listed = new_files(spark, drop)
    assert listed.isStreaming and listed.columns == ["file", "length", "modified"]


def _odd(spark, folder):
    """Stored rows: a hot id, many without one, others with a few copies."""
    rng = random.Random(3)
    rows = [(rng.choice(["HOT", None, *(f"O{k}" for k in range(80))] if q % 2 else ["HOT", None]),
             rng.choice(["No", "No", "Yes", None, "?"]), q) for q in range(600)]
    rng.shuffle(rows)
    _raw(spark, rows).write.parquet(folder)
    return spark.read.parquet(folder)


def test_a_merge_shuffles_rows_once(spark):
    merged = FirstCopies(spark, _folder(), buckets=5)
    plan = merged._first_copies(_odd(spark, _folder() + "/odd"))._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    assert plan.count("Exchange ") == 1 and "Exchange rangepartitioning(_bucket" in plan


@pytest.mark.parametrize("least", [4, 100, 10_000])
def test_hot_ids_are_cut_before_the_shuffle(spark, monkeypatch, least):
    monkeypatch.setattr(firsts_module, "HOT_ROWS", least)
    rows = _odd(spark, _folder() + "/odd")
    cut = firsts_module._without_hot_copies(rows)
    most = max(r["count"] for r in cut.groupBy("order_id").count().collect())
    assert most <= max(least, 4) or least == 10_000 and most > 100          # 4: a copy of each flag
    merged = FirstCopies(spark, _folder(), buckets=5)
    merged.merge(rows, "one")
    want = C.first_copies(rows)
    assert sorted(map(repr, merged.read().select(want.columns).collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("only", [[None], ["HOT"]])
def test_a_single_hot_id_is_cut(spark, monkeypatch, only):
    monkeypatch.setattr(firsts_module, "HOT_ROWS", 50)
    folder = _folder() + "/one"
    _raw(spark, [(only[0] if q % 3 else f"O{q}", "Yes" if q < 5 else "No", q) for q in range(300)]).write.parquet(folder)
    cut = firsts_module._without_hot_copies(spark.read.parquet(folder))
    assert cut.count() == 100 + 2 and _rows(C.first_copies(cut)) == _rows(C.first_copies(spark.read.parquet(folder)))


def test_lines_are_not_shuffled_by_their_file(spark):
    from tests.test_sources import _mixed_drop
    from tillroll.schema import RAW_SCHEMA
    from tillroll.sources.daily_csv import rows_of_lines, stored_lines
    drop = _mixed_drop()
    files = [os.path.join(drop, f) for f in sorted(os.listdir(drop))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = rows_of_lines(stored_lines(spark, files, os.path.join(_folder(), "lines")), RAW_SCHEMA)
        plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan and rows.count() == 3
