"""DuckDB SQL that recomputes each registered query from the driver's tables.

The text is written independently of the Spark code and only shares the
input mapping (FIXTURES.md section 2) and the numeric conventions:

* line revenue is an exact DECIMAL with four places;
* sums are rounded in DECIMAL (``ROUND`` half away from zero, ``ROUND_EVEN``
  half to even) and cast to DOUBLE last;
* ratios are rounded with exact integer arithmetic (DuckDB divides
  decimals in DOUBLE, which would misplace exact halves).
"""

from __future__ import annotations

SEQ_COLS = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
SEQ = ", ".join(f"seq_{c}" for c in SEQ_COLS)

SALES_COLS = ("order_id, order_date, order_time, customer_id, customer_name, region, city, salesperson, "
              "category, product_name, sku_id, quantity, unit_price, discount_pct, "
              "return_flag, payment_method, channel")

RAW = f"""
sales AS (
  SELECT
    concat('ORD-', CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR)) AS order_id,
    CAST(o.o_orderdate AS DATE) AS order_date,
    strftime(TIMESTAMP '2000-01-01' + to_seconds(CAST((l.l_orderkey * 37 + l.l_linenumber * 997) % 86400 AS BIGINT)),
             '%H:%M:%S') AS order_time,
    o.o_custkey AS customer_id,
    CASE WHEN c.c_custkey % 50 = 0 THEN '' ELSE c.c_name END AS customer_name,
    CASE WHEN l.l_partkey % 100 = 7 THEN '' ELSE r.r_name END AS region,
    n.n_name AS city,
    s.s_name AS salesperson,
    p.p_type AS category,
    p.p_name AS product_name,
    p.p_partkey AS sku_id,
    CAST(CASE WHEN (l.l_partkey + l.l_suppkey) % 100 = 3 THEN -l.l_quantity
              ELSE l.l_quantity END AS INTEGER) AS quantity,
    CAST(p.p_retailprice AS DECIMAL(12,2)) AS unit_price,
    CAST(ROUND(l.l_discount * 100) AS INTEGER) AS discount_pct,
    CASE WHEN l.l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS return_flag,
    o.o_orderpriority AS payment_method,
    o.o_orderstatus AS channel,
    {", ".join(f"l.{c} AS seq_{c}" for c in SEQ_COLS)}
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def revenue(qty: str = "ABS(quantity)") -> str:
    return (f"CAST(CAST(unit_price * {qty} * (100 - discount_pct) AS DECIMAL(30,2)) * 0.01 "
            f"AS DECIMAL(28,4))")


CLEANED_COLS = f"""order_id, order_date, order_time, customer_id,
    COALESCE(NULLIF(customer_name, ''), 'Unknown Customer') AS customer_name,
    COALESCE(NULLIF(region, ''), 'Unknown Region') AS region,
    city, salesperson, category, product_name, sku_id,
    ABS(quantity) AS quantity, unit_price, discount_pct, return_flag, payment_method, channel,
    {revenue()} AS revenue"""

ORDER_KEY = "row(" + SEQ + ")"

# The place of every row among the copies of its order, over all rows and over rows that were not returned.
PLACED = f"""
placed AS (
  SELECT sales.*, {ORDER_KEY} AS place,
         MIN({ORDER_KEY}) OVER same_order AS place_of_first,
         MIN({ORDER_KEY}) FILTER (WHERE return_flag = 'No') OVER same_order AS place_of_first_kept,
         ROW_NUMBER() OVER (PARTITION BY order_id, return_flag, {ORDER_KEY}) AS twin
  FROM sales
  WINDOW same_order AS (PARTITION BY order_id)
)"""

CLEAN = f"""
sales_clean AS (
  SELECT {CLEANED_COLS} FROM placed
  WHERE return_flag = 'No' AND place = place_of_first_kept AND twin = 1
)"""

DEDUP = f"""
dedup AS (
  SELECT {CLEANED_COLS},
    CAST(unit_price * ABS(quantity) AS DECIMAL(28,4)) AS gross_revenue,
    CAST(unit_price * ABS(quantity) AS DECIMAL(28,4)) - {revenue()} AS discount_amount
  FROM placed
  WHERE place = place_of_first AND twin = 1
),
kept AS (SELECT * FROM dedup WHERE return_flag = 'No'),
returns AS (SELECT * FROM dedup WHERE return_flag = 'Yes')"""


def with_base(body: str, *extra_ctes: str) -> str:
    ctes = [RAW, PLACED, CLEAN, DEDUP, *extra_ctes]
    return "WITH " + ",".join(ctes) + "\n" + body


# --- numeric helpers ----------------------------------------------------------

def money(expr: str, k: int = 2, even: bool = False) -> str:
    fn = "ROUND_EVEN" if even else "ROUND"
    return f"CAST({fn}({expr}, {k}) AS DOUBLE)"


def _as_int(expr: str, scale: int) -> str:
    return f"CAST(({expr}) * {10 ** scale} AS HUGEINT)" if scale else f"CAST(({expr}) AS HUGEINT)"


def rint(num: str, den: str, k: int, ns: int = 0, ds: int = 0, even: bool = False) -> str:
    """num / den rounded to k places, as the integer 10^k * result (or NULL)."""
    n = f"({_as_int(num, ns)} * {10 ** (ds + k)})"
    d = f"({_as_int(den, ds)} * {10 ** ns})"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    if even:
        q0 = f"(ABS({n}) // ABS({d}))"
        r2 = f"(2 * (ABS({n}) % ABS({d})))"
        q = (f"({q0} + CASE WHEN {r2} > ABS({d}) OR ({r2} = ABS({d}) AND {q0} % 2 = 1) "
             f"THEN 1 ELSE 0 END)")
    else:
        q = f"((2 * ABS({n}) + ABS({d})) // (2 * ABS({d})))"
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE {sign} * {q} END)"


def rdiv(num: str, den: str, k: int, ns: int = 0, ds: int = 0, even: bool = False) -> str:
    """num / den rounded to k places, exactly, as DOUBLE.  ``ns`` / ``ds`` are
    the decimal scales of num and den (both must be exact at that scale)."""
    return f"(CAST({rint(num, den, k, ns, ds, even)} AS DOUBLE) / {10 ** k})"


def rpct(num: str, den: str, k: int, ns: int = 0, ds: int = 0, even: bool = False) -> str:
    return rdiv(f"100 * ({num})", den, k, ns, ds, even)
