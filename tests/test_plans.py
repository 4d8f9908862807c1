"""Physical-plan properties of the registered queries."""

import re

import pytest

from tillroll.operators import clean as C
from tillroll.plans.materialize import load
from tillroll.registry import QUERIES
from tillroll.workspace import Drop

SF = "/root/testdata/sf0.001"
IO = {"scan_daily_csv", "csv_sales_clean", "write_raw_table", "write_clean_csv", "stream_ingest_first_copies",
      "summary_daily_trend", "summary_linear_trend", "summary_verdicts"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def fact_scans(spark, key) -> int:
    """Scans of sales or first copies in the plan that ran."""
    load(spark, SF).store_all()
    spark.catalog.clearCache()
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        df = QUERIES[key](spark, SF)
        df.collect()
        plan = _plan(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # One scan has one set of attribute ids; a persisted relation shows its scan wherever it is read.
    return len(set(re.findall(r"FileScan parquet (\[[^]]*\])[^\n]*/(?:firsts|sales)\b", plan)))


def test_first_copies_are_limited_map_side_and_not_sorted_as_aggregates(spark):
    d = load(spark, SF)
    plan = _plan(C.first_copies(d.raw))          # what the load writes
    assert "SortAggregate" not in plan
    assert re.search(r"WindowGroupLimit .*Partial(.|\n)*Scan parquet|Partial(.|\n)*FileScan", plan)
    first = plan.rindex("WindowGroupLimit")
    assert "Exchange hashpartitioning(order_id" in plan[:first]


def test_view_filter_reaches_the_stored_rows(spark):
    plan = _plan(load(spark, SF).clean)
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(return_flag,No\)", plan), plan


def test_view_filter_reaches_lineitem_scan(spark):
    plan = _plan(Drop.from_tables(spark, SF).clean)
    assert [ln for ln in plan.splitlines() if "l_returnflag" in ln and "Filter" in ln], plan


def test_only_fixed_size_tables_are_hinted(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # without automatic broadcasts
    try:
        plan = _plan(Drop.from_tables(spark, SF).raw)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 4


@pytest.mark.parametrize("key", ["q1_salesperson_rank", "q4_daily_trend", "q5_top_products", "q7_payment", "q8_channel",
                                 "q9_target_attainment", "eda_category", "eda_category_discount", "anova_region",
                                 "anova_salesperson", "anova_discount", "eta_squared", "linear_trend", "read_query"])
def test_one_scan_of_the_facts(spark, key):
    assert fact_scans(spark, key) == 1


def test_two_scans_for_all_tests(spark):
    assert fact_scans(spark, "stat_verdicts") <= 2


def test_no_window_without_partition_over_data(spark):
    # the only unpartitioned window is over the per-partition offsets (one row per partition)
    for key in ("q1_salesperson_rank", "q4_daily_trend", "q9_target_attainment"):
        for line in _plan(QUERIES[key](spark, SF)).splitlines():
            if "windowspecdefinition(" in line and "Window [" in line:
                partitioned = re.search(r"\], \[_part#\d+", line)
                over_offsets = "_off" in line or "_plast" in line or "_w" in line and "_sum_" in line
                assert partitioned or over_offsets or "_n#" in line, (key, line)


def test_building_a_query_writes_nothing(spark, tmp_path):
    import os

    from tillroll.session import local_path, scratch_root
    load(spark, SF).store_all()
    root = local_path(scratch_root(spark))
    before = sorted(os.listdir(root))
    for key in sorted(set(QUERIES) - IO):
        QUERIES[key](spark, SF)
    assert sorted(os.listdir(root)) == before


@pytest.mark.parametrize("key", sorted(set(QUERIES) - IO))
def test_no_python_in_plans(spark, key):
    plan = _plan(QUERIES[key](spark, SF))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow"):
        assert marker not in plan, key
