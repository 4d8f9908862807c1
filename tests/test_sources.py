"""CSV drops: null tokens, first copy across files and file splits."""

import csv
import os
import tempfile

from tillroll.operators import clean as C
from tillroll.operators import quality as DQ
from tillroll.schema import RAW_SCHEMA
from tillroll.sources.daily_csv import read_daily_drop, source_files

HEADER = [f.name for f in RAW_SCHEMA.fields]


def _row(order_id, name="Shop", qty=1, flag="No", price="10", day="2026-06-22"):
    return [order_id, day, "09:00:00", "CUST0001", name, "North", "Delhi", "Rep A", "Dairy",
            "Milk", "DAI-001", str(qty), price, "0", flag, "Cash", "Online"]


def _write(folder, name, rows, quote_empty=False):
    with open(os.path.join(folder, name), "w", newline="") as f:
        w = csv.writer(f, quoting=csv.QUOTE_MINIMAL)
        w.writerow(HEADER)
        for r in rows:
            w.writerow(r)
    if quote_empty:
        text = open(os.path.join(folder, name)).read().replace(",QUOTED_EMPTY,", ',"",')
        open(os.path.join(folder, name), "w").write(text)


def test_null_tokens_become_null(spark):
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    names = ["", "NA", "NULL", "nan", "n/a", "QUOTED_EMPTY", "Real Shop", "None"]
    _write(d, "sales_2026_06_22.csv", [_row(f"O{i}", name=n) for i, n in enumerate(names)],
           quote_empty=True)
    raw = read_daily_drop(spark, d)
    got = {r.order_id: r.customer_name for r in raw.collect()}
    assert got["O6"] == "Real Shop"
    assert all(v is None for k, v in got.items() if k != "O6")
    assert DQ.dq_counts(raw).collect()[0].missing_names == 7


def test_first_copy_follows_file_then_position_over_splits(spark):
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    # Day 1 holds the first copy of DUP-*; day 2 and 3 repeat them later.
    big = [_row(f"O{i:05d}") for i in range(4000)]
    big[10] = _row("DUP-1", qty=1)
    big[3990] = _row("DUP-2", qty=2)               # late in a file larger than a split
    big[3995] = _row("DUP-2", qty=99)              # second copy, same file, later split
    _write(d, "sales_2026_06_22.csv", big)
    _write(d, "sales_2026_06_23.csv", [_row("DUP-1", qty=50, day="2026-06-23")])
    _write(d, "sales_2026_06_24.csv", [_row("DUP-1", qty=70, day="2026-06-24"),
                                       _row("DUP-2", qty=80, day="2026-06-24")])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        raw = read_daily_drop(spark, d)
        assert raw.rdd.getNumPartitions() > 3    # the big file is split
        firsts = {r.order_id: r.quantity for r in C.keep_first(raw).collect()
                  if r.order_id.startswith("DUP")}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert firsts == {"DUP-1": 1, "DUP-2": 2}


def _mixed_drop():
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    _write(d, "sales_2026_06_22.csv", [_row("A", qty=1)])
    with open(os.path.join(d, "sales_2026_06_23.csv"), "w", newline="") as f:      # another order of columns
        w = csv.writer(f)
        w.writerow(list(reversed(HEADER)))
        w.writerow(list(reversed(_row("B", name="Bob", qty=2, day="2026-06-23"))))
    with open(os.path.join(d, "sales_2026_06_24.csv"), "w", newline="") as f:      # one lacks, one unknown
        w = csv.writer(f)
        w.writerow([*[h for h in HEADER if h != "channel"], "note"])
        w.writerow([*_row("C", qty=3, day="2026-06-24")[:-1], "x"])
    return d


def test_columns_are_aligned_by_name(spark):
    raw = read_daily_drop(spark, _mixed_drop())
    assert raw.columns == [*HEADER, "row_seq"]
    rows = {r.order_id: r for r in raw.collect()}
    assert {k: (r.quantity, r.customer_name, r.region, r.channel) for k, r in rows.items()} == {
        "A": (1, "Shop", "North", "Online"), "B": (2, "Bob", "North", "Online"), "C": (3, "Shop", "North", None)}


def test_numbers_as_text(spark):
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    _write(d, "sales_2026_06_22.csv", [_row("A", qty="12.0"), _row("B", qty="x"), _row("C", qty=""), _row("D", qty="2.5"),
                                       _row("E", price="ten", day="soon"), _row("F", qty=" 7 ")])
    raw = read_daily_drop(spark, d)
    assert {r.order_id: r.quantity for r in raw.collect()} == {"A": 12, "B": None, "C": None, "D": None, "E": 1, "F": 7}
    report = {r.column_name: (r["values"], r.example) for r in DQ.unparsed_report(raw).collect()}
    assert report == {"quantity": (2, "2.5"), "unit_price": (1, "ten"), "order_date": (1, "soon")}


def test_order_time_goes_all_the_way(spark):
    from tillroll.sources.sinks import write_clean_csv
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    _write(d, "sales_2026_06_22.csv", [_row("A"), _row("A"), _row("B", flag="Yes")])
    raw = read_daily_drop(spark, d)
    assert [r.order_time for r in C.sales_clean(raw).collect()] == ["09:00:00"]
    kept = C.kept_orders(raw, with_gross=True)
    back = spark.read.option("header", True).csv(write_clean_csv(kept, os.path.join(d, "out")))
    assert back.columns[:17] == HEADER and [r.order_time for r in back.collect()] == ["09:00:00"]


def test_load_drop_stores_and_replaces_tables(spark):
    from tillroll.plans.materialize import load_drop, open_drop
    store = tempfile.mkdtemp(prefix="tillroll-test-")
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    _write(d, "sales_2026_06_22.csv", [_row("A"), _row("A"), _row("B", flag="Yes")])
    drop = load_drop(spark, d, store)
    assert sorted(os.listdir(drop.store)) == ["firsts", "sales", "targets"]
    assert (drop.raw.count(), drop.clean.count(), drop.dedup.count()) == (3, 1, 2)
    assert [r.weekly_target for r in drop.targets.collect()] == [900000.0]
    _write(d, "sales_2026_06_23.csv", [_row("C")])
    again = load_drop(spark, d, store)
    assert (again.raw.count(), again.clean.count()) == (4, 2)
    assert open_drop(spark, store).raw.count() == 4 and drop.raw.count() == 3 and open_drop(spark, store, number=1).raw.count() == 3


def test_a_changed_table_is_loaded_again(spark):
    import shutil

    from tillroll.plans.materialize import load
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    for name in ("orders", "customer", "nation", "region", "supplier", "part"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", d)
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lineitem.limit(3000).write.parquet(f"{d}/lineitem.parquet")
    first = load(spark, d)
    assert first.raw.count() == 3000 and load(spark, d) is first
    lineitem.limit(1000).write.mode("append").parquet(f"{d}/lineitem.parquet")
    assert load(spark, d).raw.count() == 4000


def test_a_read_of_some_days_opens_their_months_only(spark):
    from datetime import date

    from tests.fixtures import make_raw
    from tillroll.sources.sinks import write_daily_drop
    rows = [dict(order_id=f"O{m}-{i}", order_date=date(2026, m, 1 + i)) for m in (5, 6, 7) for i in range(20)]
    d = write_daily_drop(make_raw(spark, rows), os.path.join(tempfile.mkdtemp(prefix="tillroll-test-"), "drop"))
    day = read_daily_drop(spark, d, days=(date(2026, 6, 3), date(2026, 6, 3)))
    assert [r.order_id for r in day.collect()] == ["O6-2"]
    assert day.inputFiles() and all("order_month=2026-06" in f for f in day.inputFiles())
    assert read_daily_drop(spark, d).count() == 60


def test_shared_folder_is_needed_off_local_masters():
    import pytest

    from tillroll.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_raw_table_keeps_identity_and_prunes_dates(spark):
    from datetime import date

    from pyspark.sql import functions as F

    from tests.fixtures import make_raw
    from tillroll.session import scratch_path
    from tillroll.sources.sinks import write_raw_table
    rows = [dict(order_id=f"O{i % 50}", order_date=date(2026, 6, 1 + i % 20), quantity=i)
            for i in range(400)]
    raw = make_raw(spark, rows)
    back = spark.read.parquet(write_raw_table(raw, scratch_path(spark, "raw-test")))
    assert ({r.order_id: r.quantity for r in C.keep_first(back).collect()}
            == {r.order_id: r.quantity for r in C.keep_first(raw).collect()})
    plan = back.filter(F.col("order_date") == date(2026, 6, 3))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(order_date), EqualTo(order_date" in plan


def test_overview_counts_scanned_files(spark):
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    _write(d, "sales_2026_06_22.csv", [_row("A"), _row("B")])
    _write(d, "sales_2026_06_22_late.csv", [_row("C")])          # two files, one day
    _write(d, "sales_2026_06_23.csv", [_row("D", day="2026-06-23")])
    _write(d, "sales_2026_06_24.csv", [])                        # a header alone is a file too
    raw = read_daily_drop(spark, d)
    r = DQ.dataset_overview(raw, source_files(spark, d)).collect()[0]
    assert (r.files, r.rows, r.columns) == (4, 4, 17) and r.column_names.split(", ") == HEADER
    assert str(r.first_date) == "2026-06-22" and str(r.last_date) == "2026-06-23"
