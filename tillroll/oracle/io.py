"""DuckDB twins of the sources, sinks, user SQL and incremental ingestion."""

from __future__ import annotations

from tillroll.oracle.questions import TARGETS
from tillroll.oracle.sql import with_base

SQL = {
    # Blank text written to CSV reads back as missing.
    "scan_daily_csv": """
SELECT order_id, order_date, order_time, customer_id, NULLIF(customer_name, '') AS customer_name,
       NULLIF(region, '') AS region, city, salesperson, category, product_name, sku_id, quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, discount_pct, return_flag, payment_method, channel
FROM sales""",

    "write_raw_table": """
SELECT order_id, order_date, order_time, customer_id, customer_name, region, city, salesperson, category,
       product_name, sku_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, discount_pct, return_flag,
       payment_method, channel
FROM sales""",

    "stream_ingest_first_copies": """
SELECT order_id, order_date, order_time, customer_id, customer_name, region, city, salesperson, category,
       product_name, sku_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, discount_pct, return_flag,
       payment_method, channel, CAST(revenue AS DOUBLE) AS revenue
FROM dedup""",

    "read_query": """
SELECT city, COUNT(*) AS reps, CAST(SUM(orders) AS BIGINT) AS orders, CAST(SUM(sold) AS DOUBLE) AS sold,
       COUNT(*) FILTER (WHERE CAST(sold AS DOUBLE) * 25 >= weekly_target) AS reps_on_pace
FROM (SELECT salesperson, city, COUNT(*) AS orders, CAST(SUM(revenue) AS DECIMAL(38,4)) AS sold
      FROM kept GROUP BY ALL) JOIN targets USING (salesperson)
GROUP BY city HAVING SUM(orders) >= 10""",
}

ORACLE = {k: with_base(v, TARGETS) for k, v in SQL.items()}
