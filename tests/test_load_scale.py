"""What the load, the visits and the stored summaries move and keep."""

import re
import time
from collections import Counter

import pytest

from tests.fixtures import make_raw
from tillroll import registry
from tillroll.operators import clean as C
from tillroll.operators import quality as DQ
from tillroll.plans.materialize import StoredDrop
from tillroll.plans.summaries import month_visits
from tillroll.session import write_table
from tillroll.sources.ledger import listing
from tillroll.sources.sinks import by_day, by_range
from tillroll.sources.tables import raw_first_copies, raw_sales
from tillroll.workspace import as_output

TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey long, s_name string",
    "part": "p_partkey long, p_name string, p_type string, p_retailprice double",
}


@pytest.fixture()
def star(spark, tmp_path):
    from datetime import datetime
    lines = []
    for i in range(400):        # copies of orders, returns, lines without number, part or order
        order, number = i % 37, None if i % 11 == 0 else i % 3
        lines.append((None if i % 97 == 0 else order, 99 if i % 41 == 0 else i % 5, i % 4, number, float(i % 7), float(i % 13),
                      0.05, 0.0, "RAN"[i % 3], "F", datetime(2024, 1, 1 + i % 28)))
    rows = {"lineitem": lines, "nation": [(0, "N", 0)], "region": [(0, "R")],
            "orders": [(k, k % 6, "O", datetime(2024, 1, 1 + k % 28), "1-URGENT") for k in range(35)],
            "customer": [(k, f"C{k}", 0) for k in range(5)], "supplier": [(k, f"S{k}") for k in range(4)],
            "part": [(k, f"P{k}", "PROMO", 10.0 + k) for k in range(5)]}
    for name, schema in TABLES.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _bag(df):
    return Counter(map(repr, df.select(*sorted(df.columns)).collect()))


def test_first_copies_of_the_tables_are_those_of_the_raw_rows(spark, star):
    got = raw_first_copies(spark, star)
    assert _bag(got) == _bag(C.first_copies(raw_sales(spark, star)))
    assert got.filter("order_id is null").count() == 1           # one key over all orders


def test_first_copies_take_no_shuffle_after_the_joins(spark, star):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.read.parquet(f"{star}/lineitem.parquet").filter("l_linenumber is not null")
        whole = f"{star}/numbered"
        for name in TABLES:
            (lines if name == "lineitem" else spark.read.parquet(f"{star}/{name}.parquet")).write.parquet(f"{whole}/{name}.parquet")
        drop = StoredDrop(spark, lambda: raw_sales(spark, whole), f"{star}/store", first_source=lambda: raw_first_copies(spark, whole))
        plan = drop.first_source()._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("Exchange hashpartitioning", plan)) == 8       # two sides of four joins
        drop.firsts
        assert "raw" not in drop.__dict__
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_part_of_a_bitmap_is_shuffled(spark):
    raw = make_raw(spark, [dict(order_id=f"O{i}", customer_id=i % 9, salesperson=f"S{i % 4}") for i in range(40)])
    ids = spark.createDataFrame([("customer", str(i), i) for i in range(9)] + [("salesperson", f"S{i}", i) for i in range(4)],
                                "what string, value string, id long")
    plan = month_visits(C.sales_clean(raw), C.dedup_clean(raw), ids)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("partial_bitmap_construct_agg")
    assert "Exchange" not in plan[:partial] and "Exchange hashpartitioning(month" in plan[partial:]


def test_summaries_hold_what_the_question_reads(spark, star):
    drop = StoredDrop(spark, lambda: raw_sales(spark, star), f"{star}/store", first_source=lambda: raw_first_copies(spark, star))
    held = registry._summaries(drop, "days", "months").store.version()["tables"]
    assert sorted(t for t in held if held[t]) == ["days", "months"]


@pytest.mark.parametrize("key", ["scan_daily_csv", "csv_sales_clean"])
def test_a_drop_is_written_without_a_raw_table(spark, star, key):
    got = registry.QUERIES[key](spark, star)
    drop = registry.load(spark, star)
    assert "raw" not in drop.__dict__                            # it would shuffle and write all rows once more
    want = drop.source() if key == "scan_daily_csv" else C.sales_clean(drop.source())
    columns = ["order_id", "order_date", "sku_id", "quantity", "salesperson", "return_flag"]
    known = "order_id is not null"       # rows without one are copies of each other, also over days: the first is by file
    assert got.count() > 50 and _bag(got.filter(known).select(columns)) == _bag(want.filter(known).select(columns))


@pytest.mark.parametrize("key", ["preview_head", "fill_defaults", "abs_quantity", "write_raw_table"])
def test_one_pass_over_the_raw_rows_needs_no_stored_ones(spark, star, key):
    got = registry.QUERIES[key](spark, star)
    drop = registry.load(spark, star)
    assert "raw" not in drop.__dict__                            # it would shuffle and write all rows once more
    want = {"preview_head": DQ.preview_head, "fill_defaults": C.fill_defaults, "abs_quantity": C.abs_quantity,
            "write_raw_table": lambda rows: rows}[key](raw_sales(spark, star))
    assert _bag(got) == _bag(as_output(want.drop("row_seq")))
    if key == "write_raw_table":
        assert got.count() == drop.raw.count() > 200 and _bag(drop.raw) == _bag(raw_sales(spark, star))


@pytest.mark.parametrize("deal, exchange", [(by_day, "REBALANCE_PARTITIONS_BY_COL"), (by_range, "Exchange rangepartitioning")])
def test_columns_that_follow_from_others_are_made_behind_the_last_shuffle(spark, star, deal, exchange):
    rows = raw_sales(spark, star, deal)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ORD-") < plan.index(exchange) and plan.index("n_name") < plan.index(exchange)
    assert exchange in plan and _bag(rows) == _bag(raw_sales(spark, star))


def test_a_drop_of_the_tables_is_compressed(spark, star):
    drop = registry.load(spark, star)
    path = registry._drop_dir(drop)
    files = [r.file for r in listing(spark, path).collect()]
    assert files and all(f.endswith(".csv.gz") for f in files)
    text = spark.read.option("header", True).csv(path, recursiveFileLookup=True)
    assert text.count() == raw_sales(spark, star).count() and text.columns == [c for c in drop.rows.columns if c != "row_seq"]


def test_shuffle_files_of_a_finished_write_are_removed(spark, tmp_path):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = blocks.getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}
    before = shuffled()
    write_table(spark.range(20_000).repartition(7, "id"), f"{tmp_path}/table")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before and spark.read.parquet(f"{tmp_path}/table").count() == 20_000
