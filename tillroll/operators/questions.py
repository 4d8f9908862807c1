"""The nine business questions on the cleaning view, plus the targets table.

Each function takes ``sales_clean`` (see ``operators.clean``) and returns a
lazy, ordered DataFrame with the question's output columns.  Hand-made plan
choices, all exact:

* order_id is unique after the keep-first dedup, so ``COUNT(DISTINCT
  order_id)`` is written as ``COUNT(order_id)`` (no Expand, no extra shuffle);
* whole-table denominators come from the grouped rows (the sum of exact
  group sums equals the table total): the ranking carries them along, other
  questions use ``plans.ordering.grouped_totals`` over the persisted grouped
  rows, so each question scans its table once;
* global ranks and running totals come from ``plans.ordering`` instead of
  a window without PARTITION BY;
* Q9 aggregates actuals per salesperson *before* joining targets; both
  sides are then hash-partitioned by salesperson and join without a
  further shuffle (or by broadcast when AQE sees a small side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import pct, ratio, rounded, to_double
from tillroll.plans.ordering import grouped_totals, with_rank, with_sequence
from tillroll.schema import BELOW_TARGET, MONEY, ON_TARGET, Params


def targets_dim(raw: DataFrame, weekly_target: float = Params.weekly_target) -> DataFrame:
    """Every salesperson of the *raw* drop (returns included) with a quota."""
    return (raw.select("salesperson").distinct()
               .withColumn("weekly_target", F.lit(float(weekly_target)).cast("double")))


def _money_aggs() -> list:
    return [F.sum("revenue").alias("_rev"), F.count("revenue").alias("_nrev")]


def q1_salesperson_rank(clean: DataFrame) -> DataFrame:
    g = clean.groupBy("salesperson").agg(F.count("order_id").alias("total_orders"),
                                         *_money_aggs())
    ranked = with_rank(g, "_rev", "revenue_rank", total="_all")
    return (ranked.select(
                "revenue_rank", "salesperson", "total_orders",
                rounded("_rev", 2).alias("total_revenue"),
                pct("_rev", "_all", 1).alias("pct_of_total"),
                ratio("_rev", "_nrev", 2).alias("avg_order_value"))
            .orderBy(F.desc("total_revenue"), "salesperson"))


def q2_category(clean: DataFrame) -> DataFrame:
    g = clean.groupBy("category").agg(
        F.count("order_id").alias("order_count"),
        F.countDistinct("product_name").alias("product_variety"),
        F.sum("quantity").alias("_units"),
        *_money_aggs(),
        F.sum(F.col("discount_pct") * F.col("quantity")).alias("_disc_units"))
    return (g.select(
                "category", "order_count", "product_variety",
                to_double("_units").alias("units_sold"),
                rounded("_rev", 2).alias("total_revenue"),
                ratio("_rev", "_nrev", 2).alias("avg_order_value"),
                # As asked: a percent multiplied by 100 once more (100x scale).
                pct("_disc_units", "_units", 2).alias("avg_discount_given"),
                # The same quantity-weighted mean on the percent scale.
                ratio("_disc_units", "_units", 2).alias("weighted_discount_pct"))
            .orderBy(F.desc("total_revenue"), "category"))


def with_met(df: DataFrame, key: str, aggs: list, met: DataFrame | None, salespeople: str, customers: str) -> DataFrame:
    """Rows of ``df`` grouped by ``key`` with the distinct salespeople and customers of each group.

    ``met`` (key, salespeople, customers) holds these counts, as
    ``plans.summaries`` keeps them in bitmaps; without it they are counted
    here, for which Spark multiplies every row (Expand).
    """
    if met is None:
        return df.groupBy(key).agg(F.countDistinct("salesperson").alias(salespeople),
                                   F.countDistinct("customer_id").alias(customers), *aggs)
    counts = met.select(F.col("key").alias("_met_key"), F.col("salespeople").alias(salespeople),
                        F.col("customers").alias(customers))
    return df.groupBy(key).agg(*aggs).join(counts, F.col(key).eqNullSafe(F.col("_met_key")), "left") \
        .drop("_met_key").fillna(0, [salespeople, customers])


def q3_region(clean: DataFrame, met: DataFrame | None = None) -> DataFrame:
    g = with_met(clean, "region", [
        F.count("order_id").alias("order_count"),
        F.sum("quantity").alias("_units"),
        *_money_aggs()], met, "salespeople_count", "unique_customers")
    return (g.select(
                "region", "salespeople_count", "unique_customers", "order_count",
                to_double("_units").alias("total_units"),
                rounded("_rev", 2).alias("total_revenue"),
                ratio("_rev", "_nrev", 2).alias("avg_order_value"),
                ratio("_rev", "salespeople_count", 2).alias("revenue_per_salesperson"))
            .orderBy(F.desc("total_revenue"), "region"))


def q4_daily_trend(clean: DataFrame) -> DataFrame:
    daily = clean.groupBy("order_date").agg(F.count("order_id").alias("orders"),
                                            F.sum("revenue").alias("_rev"))
    return trend_table(with_sequence(daily, "order_date", "_rev", running="_cum", previous="_prev"))


def trend_table(seq: DataFrame) -> DataFrame:
    """Q4's columns from days (order_date, orders, _rev) with running total and previous value."""
    change = (F.col("_rev") - F.col("_prev")).cast(MONEY)
    return (seq.select(
                "order_date", "orders",
                rounded("_rev", 2).alias("daily_revenue"),
                rounded("_cum", 2).alias("cumulative_revenue"),
                rounded(change, 2).alias("day_over_day_change"),
                pct(change, "_prev", 1).alias("day_over_day_pct"))
            .orderBy("order_date"))


def q5_top_products(clean: DataFrame, n: int = Params.top_n) -> DataFrame:
    g = clean.groupBy("sku_id", "product_name", "category").agg(
        F.sum("quantity").alias("_units"), *_money_aggs(),
        F.count("order_id").alias("order_count"))
    total_orders = grouped_totals(g, "order_count")["order_count"]
    return (g.select(
                "product_name", "sku_id", "category",
                to_double("_units").alias("units_sold"),
                rounded("_rev", 2).alias("product_revenue"),
                ratio("_rev", "_nrev", 2).alias("avg_order_value"),
                "order_count",
                pct("order_count", total_orders, 1).alias("pct_of_total_orders"))
            .orderBy(F.desc("product_revenue"), "sku_id", "product_name", "category")
            .limit(n))


def q6_discount(clean: DataFrame) -> DataFrame:
    g = clean.groupBy("discount_pct").agg(
        F.count("order_id").alias("order_count"),
        F.sum("quantity").alias("_units"), *_money_aggs(),
        F.sum((F.col("quantity") * F.col("unit_price")).cast(MONEY)).alias("_gross"))
    return (g.select(
                "discount_pct", "order_count",
                to_double("_units").alias("units_sold"),
                rounded("_rev", 2).alias("total_revenue"),
                ratio("_rev", "_nrev", 2).alias("avg_order_value"),
                rounded((F.col("_gross") - F.col("_rev")).cast(MONEY), 2)
                .alias("total_discount_given"))
            .orderBy("discount_pct"))


def q7_payment(clean: DataFrame) -> DataFrame:
    g = clean.groupBy("payment_method").agg(F.count("order_id").alias("order_count"),
                                            *_money_aggs())
    totals = grouped_totals(g, "order_count", "_rev")
    total_orders, total_rev = totals["order_count"], totals["_rev"]
    return (g.select(
                "payment_method", "order_count",
                pct("order_count", total_orders, 1).alias("pct_of_orders"),
                rounded("_rev", 2).alias("total_revenue"),
                pct("_rev", total_rev, 1).alias("pct_of_revenue"),
                ratio("_rev", "_nrev", 2).alias("avg_order_value"))
            .orderBy(F.desc("total_revenue"), "payment_method"))


def q8_channel(clean: DataFrame, met: DataFrame | None = None) -> DataFrame:
    g = with_met(clean, "channel", [F.count("order_id").alias("order_count"), *_money_aggs()], met,
                 "salespeople_involved", "unique_customers")
    total_rev = grouped_totals(g, "_rev")["_rev"]
    return (g.select(
                "channel", "order_count", "salespeople_involved", "unique_customers",
                rounded("_rev", 2).alias("channel_revenue"),
                pct("_rev", total_rev, 1).alias("pct_of_total_revenue"),
                ratio("_rev", "_nrev", 2).alias("avg_order_value"),
                ratio("_rev", "unique_customers", 2).alias("revenue_per_customer"))
            .orderBy(F.desc("channel_revenue"), "channel"))


def q9_target_attainment(clean: DataFrame, targets: DataFrame) -> DataFrame:
    actual = clean.groupBy("salesperson").agg(F.sum("revenue").alias("_rev"))
    joined = actual.join(targets, "salesperson")
    ranked = with_rank(joined, "_rev", "rank")
    target = F.col("weekly_target").cast(MONEY)
    return (ranked.select(
                "rank", "salesperson",
                rounded("_rev", 2).alias("actual_revenue"),
                "weekly_target",
                pct("_rev", target, 1).alias("attainment_pct"),
                F.when(F.col("_rev") >= target, F.lit(ON_TARGET))
                 .otherwise(F.lit(BELOW_TARGET)).alias("status"))
            .orderBy(F.desc("attainment_pct"), "salesperson"))
