"""DuckDB twins of the overview, profile, data-quality and row-level keys."""

from __future__ import annotations

from tillroll.oracle.sql import SALES_COLS, SEQ, rpct, with_base

OUT_COLS = SALES_COLS.replace("unit_price", "CAST(unit_price AS DOUBLE) AS unit_price")

DQ = """
dq AS (
  SELECT COUNT(*) AS rows,
         COUNT(*) FILTER (WHERE customer_name IS NULL OR customer_name = '') AS missing_names,
         COUNT(*) FILTER (WHERE region IS NULL OR region = '') AS missing_region,
         COUNT(*) FILTER (WHERE quantity < 0) AS negative_qty,
         COUNT(*) - COUNT(DISTINCT order_id)
           - MAX(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS duplicates,
         COUNT(*) FILTER (WHERE return_flag = 'Yes') AS returns
  FROM sales)"""

ISSUES = [("missing_names", "Missing customer names"),
          ("missing_region", "Missing regions"),
          ("negative_qty", "Negative quantities"),
          ("duplicates", "Duplicate order IDs"),
          ("returns", "Return orders")]

PROFILE_TYPES = [("order_id", "string"), ("order_date", "date"), ("order_time", "string"),
                 ("customer_id", "bigint"),
                 ("customer_name", "string"), ("region", "string"), ("city", "string"),
                 ("salesperson", "string"), ("category", "string"), ("product_name", "string"),
                 ("sku_id", "bigint"), ("quantity", "int"), ("unit_price", "decimal(12,2)"),
                 ("discount_pct", "int"), ("return_flag", "string"),
                 ("payment_method", "string"), ("channel", "string")]


def _profile() -> str:
    parts = []
    for i, (c, t) in enumerate(PROFILE_TYPES):
        miss = (f"{c} IS NULL OR {c} = ''" if t == "string" else f"{c} IS NULL")
        parts.append(
            f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, "
            f"COUNT(*) FILTER (WHERE {miss}) AS missing_count, "
            f"{rpct(f'COUNT(*) FILTER (WHERE {miss})', 'COUNT(*)', 2, even=True)} AS missing_pct "
            f"FROM sales")
    return "\nUNION ALL ".join(parts)


def _report() -> str:
    parts = [f"SELECT {i + 1} AS position, '{label}' AS issue, {c} AS affected_rows, "
             f"{rpct(c, 'rows', 1)} AS pct_of_rows FROM dq"
             for i, (c, label) in enumerate(ISSUES)]
    return "\nUNION ALL ".join(parts)


FILLED = OUT_COLS.replace(
    "customer_name,", "COALESCE(NULLIF(customer_name, ''), 'Unknown Customer') AS customer_name,"
).replace("region,", "COALESCE(NULLIF(region, ''), 'Unknown Region') AS region,", 1)

def _cleaned_all(gross: bool) -> str:
    body = (f"SELECT order_id, order_date, order_time, customer_id, "
            f"COALESCE(NULLIF(customer_name, ''), 'Unknown Customer') AS customer_name, "
            f"COALESCE(NULLIF(region, ''), 'Unknown Region') AS region, city, salesperson, "
            f"category, product_name, sku_id, ABS(quantity) AS quantity, "
            f"CAST(unit_price AS DOUBLE) AS unit_price, discount_pct, return_flag, "
            f"payment_method, channel, "
            f"CAST(CAST(CAST(unit_price * ABS(quantity) * (100 - discount_pct) AS DECIMAL(30,2)) "
            f"* 0.01 AS DECIMAL(28,4)) AS DOUBLE) AS revenue")
    if gross:
        body += (", CAST(CAST(unit_price * ABS(quantity) AS DECIMAL(28,4)) AS DOUBLE) AS gross_revenue"
                 ", CAST(CAST(unit_price * ABS(quantity) AS DECIMAL(28,4)) - "
                 "CAST(CAST(unit_price * ABS(quantity) * (100 - discount_pct) AS DECIMAL(30,2)) "
                 "* 0.01 AS DECIMAL(28,4)) AS DOUBLE) AS discount_amount")
    return body + " FROM sales"


DEDUP_OUT = ("order_id, order_date, order_time, customer_id, customer_name, region, city, salesperson, "
             "category, product_name, sku_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
             "discount_pct, return_flag, payment_method, channel, CAST(revenue AS DOUBLE) AS revenue, "
             "CAST(gross_revenue AS DOUBLE) AS gross_revenue, "
             "CAST(discount_amount AS DOUBLE) AS discount_amount")

SQL = {
    "dataset_overview": """
SELECT COUNT(DISTINCT order_date) AS files, COUNT(*) AS rows,
       MIN(order_date) AS first_date, MAX(order_date) AS last_date, 17 AS columns,
       'order_id, order_date, order_time, customer_id, customer_name, region, city, salesperson, category, '
       || 'product_name, sku_id, quantity, unit_price, discount_pct, return_flag, payment_method, channel' AS column_names
FROM sales""",
    "column_profile": _profile(),
    "preview_head": f"SELECT {OUT_COLS} FROM sales ORDER BY order_date, {SEQ}, order_id LIMIT 5",
    "dq_report": _report(),
    **{f"dq_{k}": f"SELECT {c} AS affected_rows, {rpct(c, 'rows', 1)} AS pct_of_rows FROM dq"
       for k, c in [("missing_names", "missing_names"), ("missing_region", "missing_region"),
                    ("negative_qty", "negative_qty"), ("duplicates", "duplicates"),
                    ("returns", "returns")]},
    "dq_rows_removed": """
SELECT (SELECT COUNT(*) FROM sales) AS raw_rows, (SELECT COUNT(*) FROM dedup) AS clean_rows,
       (SELECT COUNT(*) FROM sales) - (SELECT COUNT(*) FROM dedup) AS rows_removed,
       17 AS raw_columns, 20 AS clean_columns""",
    "fill_defaults": f"SELECT {FILLED} FROM sales",
    "abs_quantity": f"SELECT {OUT_COLS.replace('quantity,', 'ABS(quantity) AS quantity,')} FROM sales",
    "derive_revenue": _cleaned_all(False),
    "derive_gross_discount": _cleaned_all(True),
    "dedup_filter_first": f"""
SELECT {OUT_COLS} FROM placed WHERE return_flag = 'No' AND place = place_of_first_kept AND twin = 1""",
    "dedup_keep_first": f"SELECT {OUT_COLS} FROM placed WHERE place = place_of_first AND twin = 1",
    "split_kept": f"SELECT {DEDUP_OUT} FROM kept",
    "split_returns": f"SELECT {DEDUP_OUT} FROM returns",
    "drop_unknown_region": f"SELECT {DEDUP_OUT} FROM kept WHERE region <> 'Unknown Region'",
    "product_label": """
SELECT DISTINCT sku_id, product_name, printf('%s (%s)', product_name, CAST(sku_id AS VARCHAR)) AS label
FROM sales""",
}

ORACLE = {k: with_base(v, DQ) for k, v in SQL.items()}
