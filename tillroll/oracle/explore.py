"""DuckDB twins of the exploratory tables, KPIs, executive measures, charts."""

from __future__ import annotations

from tillroll.oracle.sql import money, rdiv, rint, with_base


def _g(keys: str, extra: str = "", src: str = "kept") -> str:
    conds = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return (f"SELECT {keys}, COUNT(order_id) AS orders, CAST(SUM(quantity) AS BIGINT) AS units, "
            f"ROUND_EVEN(SUM(revenue), 2) AS rev_r{extra} FROM {src} WHERE {conds} GROUP BY {keys}")


AOV = rdiv("rev_r", "orders", 2, 2, 0, even=True)
SHARE = rdiv("100 * rev_r", "(SELECT SUM(rev_r) FROM g)", 1, 2, 2, even=True)


def kilo(x: str, ns: int = 2, k: int = 5) -> str:
    return rdiv(x, "1000", k, ns, 0)


SPLIT = """
t AS (
  SELECT COUNT(*) AS dedup_rows,
         COUNT(*) FILTER (WHERE return_flag = 'No') AS total_orders,
         SUM(revenue) FILTER (WHERE return_flag = 'No') AS rev,
         COUNT(*) FILTER (WHERE return_flag = 'Yes') AS return_orders,
         COALESCE(SUM(revenue) FILTER (WHERE return_flag = 'Yes'), 0) AS loss
  FROM dedup)"""

CAT = _g("category")

SQL = {
    "eda_category": (f"""
SELECT category, orders, units, CAST(rev_r AS DOUBLE) AS revenue,
       {AOV} AS avg_order_value, {SHARE} AS pct_of_revenue
FROM g ORDER BY revenue DESC, category""", f"g AS ({CAT})"),

    "eda_category_discount": (f"""
SELECT category, orders, units, CAST(rev_r AS DOUBLE) AS revenue,
       {rdiv('sd', 'nd', 2, even=True)} AS avg_discount_pct,
       {AOV} AS avg_order_value, {SHARE} AS pct_of_revenue
FROM g ORDER BY revenue DESC, category""",
        f"g AS ({_g('category', ', SUM(discount_pct) AS sd, COUNT(discount_pct) AS nd')})"),

    "eda_daily": ("""
SELECT order_date, orders, units, CAST(rev_r AS DOUBLE) AS daily_revenue FROM g ORDER BY order_date""",
                  f"g AS ({_g('order_date')})"),

    "eda_daily_aov": (f"""
SELECT order_date, orders, units, CAST(rev_r AS DOUBLE) AS daily_revenue, {AOV} AS avg_order_value
FROM g ORDER BY order_date""", f"g AS ({_g('order_date')})"),

    "eda_region": (f"""
SELECT region, orders, customers, CAST(rev_r AS DOUBLE) AS revenue, {AOV} AS avg_order_value
FROM g ORDER BY revenue DESC, region""",
                   f"g AS ({_g('region', ', COUNT(DISTINCT customer_id) AS customers')})"),

    "eda_region_salespeople": (f"""
SELECT region, orders, customers, salespeople, CAST(rev_r AS DOUBLE) AS revenue,
       {AOV} AS avg_order_value,
       {rdiv('rev_r', 'salespeople', 2, 2, 0, even=True)} AS revenue_per_salesperson
FROM g ORDER BY revenue DESC, region""",
        f"g AS ({_g('region', ', COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT salesperson) AS salespeople')})"),

    "eda_region_efficiency": (f"""
SELECT region, CAST(rev_r AS DOUBLE) AS revenue, 10 AS team_size,
       {rdiv('rev_r', '10', 3, 2, 0)} AS revenue_per_salesperson
FROM g ORDER BY revenue DESC, region""", f"g AS ({_g('region')})"),

    "eda_products": ("""
SELECT product_name, sku_id, category, orders, units, CAST(rev_r AS DOUBLE) AS revenue
FROM g ORDER BY revenue DESC, product_name, sku_id, category""",
                     f"g AS ({_g('product_name, sku_id, category')})"),

    "eda_products_aov": (f"""
SELECT product_name, sku_id, category, orders, units, CAST(rev_r AS DOUBLE) AS revenue,
       {AOV} AS avg_order_value
FROM g ORDER BY revenue DESC, product_name, sku_id, category""",
                         f"g AS ({_g('product_name, sku_id, category')})"),

    "eda_top10_products": ("""
SELECT * FROM (
  SELECT product_name, sku_id, category, orders, units, CAST(rev_r AS DOUBLE) AS revenue
  FROM g ORDER BY revenue DESC, product_name, sku_id, category LIMIT 10)
ORDER BY revenue, product_name DESC, sku_id DESC, category DESC""",
                           f"g AS ({_g('product_name, sku_id, category')})"),

    "eda_discount": (f"""
SELECT discount_pct, orders, units, CAST(rev_r AS DOUBLE) AS net_revenue, {AOV} AS avg_order_value
FROM g ORDER BY discount_pct""", f"g AS ({_g('discount_pct')})"),

    "eda_discount_gross": (f"""
SELECT discount_pct, orders, units, CAST(rev_r AS DOUBLE) AS net_revenue,
       CAST(ROUND_EVEN(gross, 2) AS DOUBLE) AS gross_revenue,
       CAST(ROUND_EVEN(gross, 2) - rev_r AS DOUBLE) AS discount_lost,
       {AOV} AS avg_order_value
FROM g ORDER BY discount_pct""", f"g AS ({_g('discount_pct', ', SUM(gross_revenue) AS gross')})"),

    "discount_tier_units": (f"""
SELECT discount_pct, {rdiv('SUM(quantity)', 'COUNT(quantity)', 1, even=True)} AS avg_units
FROM kept WHERE discount_pct IS NOT NULL GROUP BY discount_pct ORDER BY discount_pct""",),

    "kpi_summary": (f"""
SELECT total_orders, {money('rev', 2, True)} AS total_revenue,
       {rdiv('rev', 'total_orders', 2, 4, 0, even=True)} AS avg_order_value,
       {money('loss', 2, True)} AS return_loss
FROM t""", SPLIT),

    "kpi_returns": (f"""
SELECT return_orders, {rdiv('100 * return_orders', 'dedup_rows', 1, even=True)} AS return_rate_pct,
       {money('loss', 2, True)} AS return_loss, {money('rev - loss', 2, True)} AS net_revenue,
       {rdiv('100 * loss', 'rev', 1, 4, 4, even=True)} AS loss_pct_of_revenue
FROM t""", SPLIT),

    "kpi_dashboard": (f"""
SELECT 1 AS position, 'Total Revenue' AS kpi, {money('rev', 2, True)} AS value FROM t
UNION ALL SELECT 2, 'Net Revenue', {money('rev - loss', 2, True)} FROM t
UNION ALL SELECT 3, 'Total Orders', CAST(total_orders AS DOUBLE) FROM t
UNION ALL SELECT 4, 'Avg Order Value', {rdiv('rev', 'total_orders', 2, 4, 0, even=True)} FROM t
UNION ALL SELECT 5, 'Return Rate %', {rdiv('100 * return_orders', 'dedup_rows', 1, even=True)} FROM t""",
                      SPLIT),

    "kpi_daily_average": (f"""
SELECT {money('SUM(revenue)', 2, True)} AS total_revenue, 8 AS period_days,
       {rdiv('SUM(revenue)', '8', 2, 4, 0, even=True)} AS daily_average,
       COUNT(DISTINCT order_date) AS days_observed,
       {rdiv('SUM(revenue)', 'COUNT(DISTINCT order_date)', 2, 4, 0, even=True)} AS daily_average_observed
FROM kept""",),

    "exec_best_worst_region": (f"""
SELECT b.region AS best_region, CAST(b.rev_r AS DOUBLE) AS best_revenue,
       w.region AS worst_region, CAST(w.rev_r AS DOUBLE) AS worst_revenue,
       CAST(b.rev_r - w.rev_r AS DOUBLE) AS gap,
       {rdiv('100 * (b.rev_r - w.rev_r)', 'w.rev_r', 1, 2, 2, even=True)} AS gap_pct
FROM (SELECT * FROM g ORDER BY rev_r DESC, region LIMIT 1) b,
     (SELECT * FROM g ORDER BY rev_r, region LIMIT 1) w""",
                               f"g AS ({_g('region', src='(SELECT * FROM kept WHERE region <> ' + chr(39) + 'Unknown Region' + chr(39) + ')')})"),

    "exec_peak_weak_day": ("""
SELECT p.order_date AS peak_day, CAST(p.rev_r AS DOUBLE) AS peak_revenue,
       w.order_date AS weak_day, CAST(w.rev_r AS DOUBLE) AS weak_revenue
FROM (SELECT * FROM g ORDER BY rev_r DESC, order_date LIMIT 1) p,
     (SELECT * FROM g ORDER BY rev_r, order_date LIMIT 1) w""", f"g AS ({_g('order_date')})"),

    "exec_discount_share": (f"""
SELECT CAST(ROUND_EVEN(base, 2) AS DOUBLE) AS base_tier_revenue,
       {rdiv('100 * ROUND_EVEN(base, 2)', 'rev', 1, 2, 4, even=True)} AS base_tier_pct,
       {rdiv('100 * rev - 100 * ROUND_EVEN(base, 2)', 'rev', 1, 4, 4, even=True)} AS discounted_pct,
       {money('given', 2, True)} AS total_discount_given
FROM (SELECT SUM(revenue) AS rev, SUM(revenue) FILTER (WHERE discount_pct = 0) AS base,
             SUM(discount_amount) AS given FROM kept)""",),

    "exec_volume_lift": (f"""
SELECT 0 AS base_tier, 10 AS deep_tier,
       {rdiv('ub', 'ob', 2, even=True)} AS base_units_per_order,
       {rdiv('ud', 'od', 2, even=True)} AS deep_units_per_order,
       {rdiv('(ud * ob - ub * od) * 100', 'ub * od', 1, even=True)} AS volume_lift_pct
FROM (SELECT SUM(quantity) FILTER (WHERE discount_pct = 0) AS ub,
             COUNT(*) FILTER (WHERE discount_pct = 0) AS ob,
             SUM(quantity) FILTER (WHERE discount_pct = 10) AS ud,
             COUNT(*) FILTER (WHERE discount_pct = 10) AS od FROM kept)""",),

    "exec_top2_share": (f"""
SELECT MAX(category) FILTER (WHERE rn = 1) AS first_category,
       MAX(category) FILTER (WHERE rn = 2) AS second_category,
       CAST(SUM(CAST(share AS DECIMAL(10,1))) AS DOUBLE) AS top2_share_pct
FROM (SELECT category, {SHARE} AS share,
             ROW_NUMBER() OVER (ORDER BY rev_r DESC, category) AS rn FROM g)
WHERE rn <= 2""", f"g AS ({CAT})"),

    "exec_named_category_share": (f"""
SELECT w.position, w.category, COALESCE(c.pct_of_revenue, 0.0) AS pct_of_revenue, c.revenue
FROM (VALUES (1, 'PROMO'), (2, 'STANDARD')) w(position, category)
LEFT JOIN (SELECT category, CAST(rev_r AS DOUBLE) AS revenue, {SHARE} AS pct_of_revenue FROM g) c
  ON w.category = c.category
ORDER BY w.position""", f"g AS ({CAT})"),

    "chart_category": (f"""
SELECT category, {kilo('rev_r')} AS revenue_k, {SHARE} AS share_pct FROM g ORDER BY revenue_k, category""",
                       f"g AS ({CAT})"),

    "chart_daily": (f"""
SELECT order_date, {kilo('rev_r')} AS revenue_k, orders, {rdiv('units', '100', 2)} AS units_hundreds
FROM g ORDER BY order_date""", f"g AS ({_g('order_date')})"),

    "chart_region": (f"""
SELECT region, {kilo('rev_r')} AS revenue_k, orders, {AOV} AS avg_order_value,
       {rdiv('rev_r', '10000', 6, 2, 0)} AS per_rep_k_fixed_team,
       {rdiv(rint('rev_r', 'salespeople', 2, 2, 0, even=True), '100000', 6)} AS per_rep_k
FROM g ORDER BY revenue_k, region""",
                     f"g AS ({_g('region', ', COUNT(DISTINCT salesperson) AS salespeople')})"),

    "chart_top_products": (f"""
SELECT printf('%s (%s)', product_name, CAST(sku_id AS VARCHAR)) AS label, category,
       {kilo('rev_r')} AS revenue_k
FROM (SELECT * FROM g ORDER BY rev_r DESC, product_name, sku_id, category LIMIT 10)
ORDER BY revenue_k, label DESC""", f"g AS ({_g('product_name, sku_id, category')})"),

    "chart_discount": (f"""
SELECT discount_pct, orders, {AOV} AS avg_order_value, {kilo('rev_r')} AS net_revenue_k,
       {kilo('ROUND_EVEN(gross, 2)')} AS gross_revenue_k
FROM g ORDER BY discount_pct""", f"g AS ({_g('discount_pct', ', SUM(gross_revenue) AS gross')})"),
}

ORACLE = {k: with_base(v[0], *v[1:]) for k, v in SQL.items()}
