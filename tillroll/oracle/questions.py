"""DuckDB twins of the nine questions, the view and the targets table.

Each question is built from its definition: one CTE ``f`` of grouped facts,
and above it ranks, running values and shares, whose totals come from ``f``.
"""

from __future__ import annotations

from tillroll.oracle.sql import SALES_COLS, money, rdiv, rpct, with_base

TARGETS = """
targets AS (SELECT salesperson, CAST(7600000 AS DOUBLE) AS weekly_target FROM sales GROUP BY salesperson)"""


def facts(keys: str, *measures: str) -> str:
    """``f``: orders, valued orders, revenue and further measures by ``keys``."""
    more = "".join(f",\n  {m}" for m in measures)
    return f"""
f AS (
  SELECT {keys}, COUNT(order_id) AS orders, COUNT(revenue) AS valued,
  CAST(SUM(revenue) AS DECIMAL(38,4)) AS rev{more}
  FROM sales_clean GROUP BY {keys})"""


UNITS = "CAST(SUM(quantity) AS BIGINT) AS units"
AOV = rdiv("rev", "valued", 2, 4, 0)
ALL_REV = "(SELECT CAST(SUM(rev) AS DECIMAL(38,4)) FROM f)"
ALL_ORDERS = "(SELECT SUM(orders) FROM f)"

SQL = {
    "sales_clean": ([], f"""
SELECT {SALES_COLS.replace('unit_price', 'CAST(unit_price AS DOUBLE) AS unit_price')},
       CAST(revenue AS DOUBLE) AS revenue
FROM sales_clean"""),

    "targets_dim": ([], "SELECT salesperson, weekly_target FROM targets"),

    "q1_salesperson_rank": ([facts("salesperson")], f"""
SELECT 1 + (SELECT COUNT(*) FROM f better WHERE better.rev > f.rev) AS revenue_rank, salesperson,
       orders AS total_orders, {money('rev')} AS total_revenue, {rpct('rev', ALL_REV, 1, 4, 4)} AS pct_of_total,
       {AOV} AS avg_order_value
FROM f"""),

    "q2_category": ([facts("category", UNITS, "COUNT(DISTINCT product_name) AS variety",
                           "CAST(SUM(discount_pct * quantity) AS BIGINT) AS discounted")], f"""
SELECT category, orders AS order_count, variety AS product_variety, CAST(units AS DOUBLE) AS units_sold,
       {money('rev')} AS total_revenue, {AOV} AS avg_order_value,
       {rpct('discounted', 'units', 2)} AS avg_discount_given,
       {rdiv('discounted', 'units', 2)} AS weighted_discount_pct
FROM f"""),

    "q3_region": ([facts("region", UNITS, "COUNT(DISTINCT salesperson) AS reps",
                         "COUNT(DISTINCT customer_id) AS customers")], f"""
SELECT region, reps AS salespeople_count, customers AS unique_customers, orders AS order_count,
       CAST(units AS DOUBLE) AS total_units, {money('rev')} AS total_revenue, {AOV} AS avg_order_value,
       {rdiv('rev', 'reps', 2, 4, 0)} AS revenue_per_salesperson
FROM f"""),

    "q4_daily_trend": ([facts("order_date"), """
steps AS (
  SELECT *, (SELECT CAST(SUM(p.rev) AS DECIMAL(38,4)) FROM f p WHERE p.order_date <= f.order_date) AS so_far,
         (SELECT arg_max(p.rev, p.order_date) FROM f p WHERE p.order_date < f.order_date) AS before
  FROM f)"""], f"""
SELECT order_date, orders, {money('rev')} AS daily_revenue, {money('so_far')} AS cumulative_revenue,
       {money('rev - before')} AS day_over_day_change,
       {rpct('rev - before', 'before', 1, 4, 4)} AS day_over_day_pct
FROM steps"""),

    "q5_top_products": ([facts("sku_id, product_name, category", UNITS)], f"""
SELECT product_name, sku_id, category, CAST(units AS DOUBLE) AS units_sold, {money('rev')} AS product_revenue,
       {AOV} AS avg_order_value, orders AS order_count, {rpct('orders', ALL_ORDERS, 1)} AS pct_of_total_orders
FROM f ORDER BY product_revenue DESC, sku_id, product_name, category LIMIT 10"""),

    "q6_discount": ([facts("discount_pct", UNITS,
                           "CAST(SUM(CAST(quantity * unit_price AS DECIMAL(28,4))) AS DECIMAL(38,4)) AS listed")], f"""
SELECT discount_pct, orders AS order_count, CAST(units AS DOUBLE) AS units_sold, {money('rev')} AS total_revenue,
       {AOV} AS avg_order_value, {money('listed - rev')} AS total_discount_given
FROM f"""),

    "q7_payment": ([facts("payment_method")], f"""
SELECT payment_method, orders AS order_count, {rpct('orders', ALL_ORDERS, 1)} AS pct_of_orders,
       {money('rev')} AS total_revenue, {rpct('rev', ALL_REV, 1, 4, 4)} AS pct_of_revenue, {AOV} AS avg_order_value
FROM f"""),

    "q8_channel": ([facts("channel", "COUNT(DISTINCT salesperson) AS reps",
                          "COUNT(DISTINCT customer_id) AS customers")], f"""
SELECT channel, orders AS order_count, reps AS salespeople_involved, customers AS unique_customers,
       {money('rev')} AS channel_revenue, {rpct('rev', ALL_REV, 1, 4, 4)} AS pct_of_total_revenue,
       {AOV} AS avg_order_value, {rdiv('rev', 'customers', 2, 4, 0)} AS revenue_per_customer
FROM f"""),

    "q9_target_attainment": ([facts("salesperson"), """
aimed AS (SELECT f.*, weekly_target, CAST(weekly_target AS DECIMAL(38,4)) AS aim FROM f JOIN targets USING (salesperson))"""],
                             f"""
SELECT 1 + (SELECT COUNT(*) FROM aimed better WHERE better.rev > aimed.rev) AS rank, salesperson,
       {money('rev')} AS actual_revenue, weekly_target, {rpct('rev', 'aim', 1, 4, 4)} AS attainment_pct,
       CASE WHEN rev < aim THEN 'Below Target' ELSE 'On Target' END AS status
FROM aimed"""),
}

ORACLE = {k: with_base(body, TARGETS, *ctes) for k, (ctes, body) in SQL.items()}
