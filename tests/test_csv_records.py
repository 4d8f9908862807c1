"""Records of quoted CSV against Python's csv module, and the ledger of files."""

import csv
import datetime
import io
import os
import random
import tempfile

import pytest

from tests.test_sources import HEADER, _row, _write
from tillroll.schema import NULL_TOKENS
from tillroll.sources.daily_csv import read_daily_drop
from tillroll.sources.ledger import Ledger, listing
from tillroll.sources.sinks import write_clean_csv, write_daily_drop

PIECES = ["a", "b c", ",", '"', '""', "\\", "\n", "\r\n", "'", "é", " ", "x" * 40]


def _folder():
    return tempfile.mkdtemp(prefix="tillroll-test-")


def _small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def read_names(spark, d):
    """order_id and customer_name by file order."""
    raw = read_daily_drop(spark, d)
    return [(r.order_id, r.customer_name) for r in raw.orderBy("row_seq").collect()]


def by_csv(d):
    out = []
    for name in sorted(os.listdir(d)):
        with open(os.path.join(d, name), newline="") as f:
            for r in csv.DictReader(f):
                out.append((r["order_id"], None if r["customer_name"] in NULL_TOKENS else r["customer_name"]))
    return out


@pytest.mark.parametrize("split, ends", [("128m", "\r\n"), ("200", "\n")])
def test_quoted_fields_equal_the_csv_module(spark, split, ends):
    rng = random.Random(len(split) + len(ends))
    d = _folder()
    for day in (22, 23, 24):
        with open(os.path.join(d, f"sales_2026_06_{day}.csv"), "w", newline="") as f:
            w = csv.writer(f, lineterminator=ends, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
            w.writerow(HEADER)
            for k in range(60):
                hard = day != 23 and rng.random() < 0.4
                name = "".join(rng.choices(PIECES, k=rng.randrange(1, 8))) if hard else "plain"
                w.writerow(_row(f"O{day}-{k}", name=name, day=f"2026-06-{day}"))
    _small_splits(spark, split)
    try:
        assert read_names(spark, d) == by_csv(d)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_records_of_the_finding(spark):
    d = _folder()
    lines = [",".join(HEADER), 'O1,2026-06-22,,,"Bob ""The, Man"" X",,,,,,,3,1,0,No,,', 'O2,2026-06-22,,,"C:\\",,,,,,,4,1,0,No,,',
             'O3,2026-06-22,,,"two', 'lines",,,,,,,5,1,0,No,,', 'O4,2026-06-22,,,5" pipe,,,,,,,6,1,0,No,,', "",
             'O5,2026-06-22,,,a "quoted" word,,,,,,,7,1,0,No,,']
    with open(os.path.join(d, "sales.csv"), "w", newline="") as f:
        f.write("\n".join(lines) + "\n")
    got = read_daily_drop(spark, d).orderBy("row_seq").collect()
    assert [(r.order_id, r.customer_name, r.quantity) for r in got] == [
        ("O1", 'Bob "The, Man" X', 3), ("O2", "C:\\", 4), ("O3", "two\nlines", 5), ("O4", '5" pipe', 6),
        ("O5", 'a "quoted" word', 7)]
    assert all(not r.row_seq.faults for r in got)


def test_an_unclosed_quote_is_an_error(spark):
    d = _folder()
    with open(os.path.join(d, "sales.csv"), "w") as f:
        f.write(",".join(HEADER) + '\nO1,2026-06-22,,,"never closed\nO2,2026-06-22\n')
    with pytest.raises(ValueError, match="never closed"):
        read_daily_drop(spark, d).collect()


def test_written_csv_is_read_by_the_csv_module(spark):
    from tests.fixtures import make_raw
    names = ['a "q", b', "C:\\", "two\nlines", " blanks ", "cr\r\nlf", "plain", "tab\t", '"', "ends\\"]
    raw = make_raw(spark, [dict(order_id=f"O{i}", customer_name=n) for i, n in enumerate(names)])
    out = write_clean_csv(raw.drop("row_seq"), os.path.join(_folder(), "out"))
    drop = write_daily_drop(raw, os.path.join(_folder(), "drop"))
    for top in (out, drop):
        parts = [os.path.join(x, f) for x, _, files in os.walk(top) for f in files if f.endswith(".csv")]
        found = {}
        for part in parts:
            with open(part, newline="") as f:
                found |= {r["order_id"]: r["customer_name"] for r in csv.DictReader(io.StringIO(f.read(), newline=""))}
        assert found == {f"O{i}": n for i, n in enumerate(names)}
    assert {r.order_id: r.customer_name for r in read_daily_drop(spark, drop).collect()} == found


def test_headers_of_several_forms_in_one_scan(spark):
    d = _folder()
    for k in range(6):
        names = HEADER[k:] + HEADER[:k] if k % 2 else [h for h in HEADER if h != HEADER[k + 5]] + ["note"]
        values = dict(zip(HEADER, _row(f"O{k}", name="two\nlines" if k > 3 else "Shop", qty=k)), note="x")
        with open(os.path.join(d, f"sales_{k}.csv"), "w", newline="", encoding="utf-8-sig" if k == 2 else "utf-8") as f:
            w = csv.writer(f)
            w.writerow(names)
            w.writerow([values[n] for n in names])
    with open(os.path.join(d, "sales_other.csv"), "w") as f:
        f.write("nothing,known\n1,2\n")
    open(os.path.join(d, "sales_none.csv"), "w").close()
    raw = read_daily_drop(spark, d)
    rows = {r.order_id: r for r in raw.collect()}
    assert set(rows) == {None, *(f"O{k}" for k in range(6))}
    for k in range(6):
        lacks = HEADER[k + 5] if k % 2 == 0 else None
        got = rows[f"O{k}"].asDict()
        assert (lacks is None or got[lacks] is None) and (got["salesperson"] == "Rep A" or lacks == "salesperson")
    plan = raw._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan csv") == 1


def _flat(d, days, first=datetime.date(2023, 1, 1)):
    for k in range(days):
        day = first + datetime.timedelta(k)
        _write(d, f"sales_{day:%Y_%m_%d}.csv", [_row(f"O{k}", day=str(day)), _row(f"P{k}", day=str(day))])


def test_one_day_of_many_flat_files_opens_one_file(spark):
    d, book = _folder(), _folder()
    _flat(d, 1000)
    day = datetime.date(2024, 5, 6)
    got = read_daily_drop(spark, d, days=(day, day), ledger=book)
    assert len(got.inputFiles()) == 1 and sorted(r.order_id for r in got.collect()) == ["O491", "P491"]
    week = read_daily_drop(spark, d, days=(day, day + datetime.timedelta(6)), ledger=book)
    assert len(week.inputFiles()) == 7 and week.count() == 14


def test_the_ledger_looks_into_new_and_changed_files_only(spark, monkeypatch):
    from tillroll.sources import ledger as L
    d, book = _folder(), _folder()
    _flat(d, 5)
    looked = []
    facts = L._facts
    monkeypatch.setattr(L, "_facts", lambda spark, files, fields: looked.append(sorted(files)) or facts(spark, files, fields))
    assert read_daily_drop(spark, d, ledger=book).count() == 10
    assert read_daily_drop(spark, d, ledger=book).count() == 10
    assert len(looked) == 1 and len(looked[0]) == 5
    _write(d, "sales_2023_01_03.csv", [_row("late")] * 3)          # changed
    _write(d, "sales_2023_02_01.csv", [_row("new", name="two\nlines")])
    assert read_daily_drop(spark, d, ledger=book).count() == 8 + 3 + 1
    assert [f.rsplit("/", 1)[1] for f in looked[1]] == ["sales_2023_01_03.csv", "sales_2023_02_01.csv"]
    kept = Ledger(spark, book).record_files(listing(spark, d), HEADER)
    assert {r.file.rsplit("/", 1)[1] for r in kept.collect() if r.multiline} == {"sales_2023_02_01.csv"}
    plan = listing(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan                          # names only, no content


def test_folders_in_folders_patterns_and_lists(spark):
    d = _folder()
    for k, sub in enumerate(("", "2026", "2026/06", "order_month=2026-06")):
        os.makedirs(os.path.join(d, sub), exist_ok=True)
        _write(os.path.join(d, sub), f"sales {k} [x].csv", [_row(f"O{k}")])
    ids = lambda path: sorted(r.order_id for r in read_daily_drop(spark, path).collect())
    assert ids(d) == ["O0", "O1", "O2", "O3"]
    assert ids(f"{d}/2026/*.csv") == ["O1"] and ids([f"{d}/2026/06", f"{d}/order_month=2026-06"]) == ["O2", "O3"]
    _write(d, "sales_9.csv", [_row("O9", name="two\nlines")])
    assert ids(d) == ["O0", "O1", "O2", "O3", "O9"]
