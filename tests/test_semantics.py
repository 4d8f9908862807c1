"""Semantics of cleaning, questions and exploration on hand-made rows."""

from datetime import date

import pytest

from tests.fixtures import make_raw
from tillroll.operators import clean as C
from tillroll.operators import explore as X
from tillroll.operators import quality as DQ
from tillroll.operators import questions as Q


def test_filter_then_dedup_differs_from_dedup_then_filter(spark):
    raw = make_raw(spark, [dict(order_id="A", return_flag="Yes", quantity=2),
                           dict(order_id="A", return_flag="No", quantity=3)])
    view = C.sales_clean(raw).collect()
    assert [(r.order_id, r.quantity) for r in view] == [("A", 3)]
    assert C.kept_orders(raw).count() == 0
    assert C.returned_orders(raw).count() == 1


def test_keep_first_then_abs_gives_same_quantity(spark):
    raw = make_raw(spark, [dict(order_id="A", quantity=4), dict(order_id="A", quantity=-4)])
    assert [r.quantity for r in C.dedup_clean(raw).collect()] == [4]
    raw2 = make_raw(spark, [dict(order_id="A", quantity=-4), dict(order_id="A", quantity=4)])
    assert [r.quantity for r in C.dedup_clean(raw2).collect()] == [4]


def test_fill_defaults_blank_and_null(spark):
    raw = make_raw(spark, [dict(order_id="A", customer_name="", region=None),
                           dict(order_id="B", customer_name=None, region="")])
    rows = C.fill_defaults(raw).orderBy("order_id").collect()
    assert {(r.customer_name, r.region) for r in rows} == {("Unknown Customer", "Unknown Region")}


def test_revenue_is_exact_decimal(spark):
    raw = make_raw(spark, [dict(order_id="A", unit_price="19.99", quantity=3, discount_pct=15)])
    rev = C.dedup_clean(raw).collect()[0].revenue
    assert str(rev) == "50.9745"


def test_null_category_dropped_by_eda_kept_by_sql(spark):
    raw = make_raw(spark, [dict(order_id="A", category=None), dict(order_id="B"),
                           dict(order_id="C", category="Snacks")])
    sql_cats = {r.category for r in Q.q2_category(C.sales_clean(raw)).collect()}
    eda_cats = {r.category for r in X.eda_category(C.kept_orders(raw)).collect()}
    assert None in sql_cats and None not in eda_cats


def test_daily_trend_lag_and_guarded_division(spark):
    one_day = make_raw(spark, [dict(order_id="A")])
    r = Q.q4_daily_trend(C.sales_clean(one_day)).collect()
    assert r[0].day_over_day_change is None and r[0].day_over_day_pct is None
    raw = make_raw(spark, [dict(order_id="A", order_date=date(2026, 6, 22), unit_price=0),
                           dict(order_id="B", order_date=date(2026, 6, 23), unit_price=10)])
    rows = Q.q4_daily_trend(C.sales_clean(raw)).collect()
    assert rows[1].day_over_day_change == 10.0
    assert rows[1].day_over_day_pct is None          # previous day had zero revenue
    assert rows[1].cumulative_revenue == 10.0


def test_rank_ties_leave_gaps(spark):
    raw = make_raw(spark, [dict(order_id="A", salesperson="S1", unit_price=100),
                           dict(order_id="B", salesperson="S2", unit_price=100),
                           dict(order_id="C", salesperson="S3", unit_price=50),
                           dict(order_id="D", salesperson="S4", unit_price=10)])
    ranks = {r.salesperson: r.revenue_rank for r in Q.q1_salesperson_rank(C.sales_clean(raw)).collect()}
    assert ranks == {"S1": 1, "S2": 1, "S3": 3, "S4": 4}


def test_q9_status_and_inner_join(spark):
    raw = make_raw(spark, [dict(order_id="A", salesperson="S1", unit_price=1000, quantity=1000),
                           dict(order_id="B", salesperson="S2", unit_price=10),
                           dict(order_id="C", salesperson="S3", return_flag="Yes")])
    clean = C.sales_clean(raw)
    targets = Q.targets_dim(raw, 900000.0)
    assert targets.count() == 3                       # reps with returns only have a target
    rows = {r.salesperson: r for r in Q.q9_target_attainment(clean, targets).collect()}
    assert set(rows) == {"S1", "S2"}                  # ... but no attainment row
    assert rows["S1"].status == "On Target" and rows["S2"].status == "Below Target"
    assert rows["S1"].attainment_pct == 111.1


def test_duplicates_count_null_ids_once(spark):
    raw = make_raw(spark, [dict(order_id="A"), dict(order_id="A"), dict(order_id=None),
                           dict(order_id=None), dict(order_id="B")])
    assert DQ.dq_counts(raw).collect()[0].duplicates == 2


def test_pandas_rounding_is_half_even(spark):
    # Revenue 0.125 per category -> .round(2) gives 0.12 (half to even)
    raw = make_raw(spark, [dict(order_id="A", unit_price="0.25", quantity=1, discount_pct=50)])
    row = X.eda_category(C.kept_orders(raw)).collect()[0]
    assert row.revenue == 0.12
    sql = Q.q2_category(C.sales_clean(raw)).collect()[0]
    assert sql.total_revenue == 0.13                  # SQL ROUND: half away from zero


@pytest.mark.parametrize("tier,expected", [(10, 100.0), (15, None)])
def test_volume_lift_missing_tier_is_null(spark, tier, expected):
    raw = make_raw(spark, [dict(order_id="A", discount_pct=0, quantity=2),
                           dict(order_id="B", discount_pct=10, quantity=4)])
    row = X.exec_volume_lift(C.kept_orders(raw), 0, tier).collect()[0]
    assert row.volume_lift_pct == expected


def test_drop_first_rows_equal_window_dedup(spark):
    from collections import Counter

    from tillroll.workspace import Drop
    raw = make_raw(spark, [dict(order_id="A", return_flag="Yes", quantity=2),
                           dict(order_id="A", return_flag="No", quantity=3),
                           dict(order_id="B", quantity=5), dict(order_id="B", quantity=6)])
    d = Drop(spark, raw)

    def bag(df):
        return Counter(tuple(r) for r in df.collect())
    assert bag(d.first_rows.drop("row_seq")) == bag(C.keep_first(raw).drop("row_seq"))
    assert bag(d.first_kept_rows.drop("row_seq")) == bag(C.keep_first(C.split_kept(raw)).drop("row_seq"))


def test_volume_lift_with_totals_beyond_1e15(spark):
    big = 2_000_000_000
    rows = [dict(order_id=f"O{i}", quantity=big, discount_pct=0 if i % 2 else 15) for i in range(1000)]
    kept = C.kept_orders(make_raw(spark, rows)).selectExpr("discount_pct", "cast(quantity as bigint) * 1000000 as quantity")
    r = X.exec_volume_lift(kept).collect()[0]
    assert (r.base_units_per_order, r.deep_units_per_order, r.volume_lift_pct) == (2e15, 2e15, 0.0)


def test_top2_share_of_one_category(spark):
    r = X.exec_top2_share(C.kept_orders(make_raw(spark, [dict(order_id="A")]))).collect()[0]
    assert (r.first_category, r.second_category, r.top2_share_pct) == ("Dairy", None, 100.0)
