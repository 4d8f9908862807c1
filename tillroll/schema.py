"""Column layout of a daily order drop, parameters and fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Exact money: unit prices are cents, line revenue has four decimals
# (price x units x percent / 100), sums stay exact until they are rounded.
PRICE = T.DecimalType(12, 2)
MONEY = T.DecimalType(28, 4)

# One CSV per day, header row, these 17 columns in this order.
RAW_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("order_time", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("salesperson", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("sku_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", PRICE),
    T.StructField("discount_pct", T.IntegerType()),
    T.StructField("return_flag", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("channel", T.StringType()),
])

# All 17 columns, in order; cleaning carries every one of them.
SALES_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Hidden column giving the "first copy" order of raw rows: file order, then
# position in the file.  Sources attach it; cleaning orders by it.
ROW_SEQ = "row_seq"
# Folder column of written drops (the files hold every real column).
DROP_MONTH = "order_month"

# --- fixed values -----------------------------------------------------------
# Values the analyses must reproduce exactly (labels, thresholds, defaults).
# Text a default pandas CSV read treats as missing (pandas read_csv,
# ``na_values`` default list).  Text columns holding one of these are null.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
UNKNOWN_CUSTOMER = "Unknown Customer"
UNKNOWN_REGION = "Unknown Region"
KEPT_FLAG = "No"
RETURN_FLAG = "Yes"
ON_TARGET = "On Target"
BELOW_TARGET = "Below Target"
SIGNIFICANCE_ALPHA = 0.05
SIGNIFICANT = "SIGNIFICANT"
NOT_SIGNIFICANT = "NOT significant"
# Effect-size bands for eta squared and their labels (below 0.01, 0.06, 0.14, above).
ETA_BANDS = (0.01, 0.06, 0.14)
EFFECT_LABELS = ("negligible", "small", "medium", "large")
LOW_R2 = 0.3
DQ_ISSUE_LABELS = ("Missing customer names", "Missing regions", "Negative quantities",
                   "Duplicate order IDs", "Return orders")
KPI_CARD_LABELS = ("Total Revenue", "Net Revenue", "Total Orders", "Avg Order Value",
                   "Return Rate %")
DEFAULT_PERIOD_DAYS = 8
DEFAULT_TEAM_SIZE = 10
DEFAULT_BASE_TIER = 0
DEFAULT_DEEP_TIER = 15
DEFAULT_NAMED_CATEGORIES = ("Dairy", "Beverages")
DEFAULT_WEEKLY_TARGET = 900000.0
DEFAULT_TRAILING_DAYS = 3
DEFAULT_TOP_N = 10
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    """Constants of the analyses (defaults: the fixed values above).

    ``period_days`` divides revenue into a daily average and ``team_size``
    divides regional revenue per salesperson (both were fixed numbers in
    the original analyses).  ``deep_tier`` is the discount tier compared
    with ``base_tier`` for the volume lift; on the driver's tables the
    deepest tier is 10.  ``weekly_target`` is the uniform rep quota.
    """

    period_days: int = DEFAULT_PERIOD_DAYS
    team_size: int = DEFAULT_TEAM_SIZE
    base_tier: int = DEFAULT_BASE_TIER
    deep_tier: int = DEFAULT_DEEP_TIER
    named_categories: tuple[str, ...] = DEFAULT_NAMED_CATEGORIES
    weekly_target: float = DEFAULT_WEEKLY_TARGET
    trailing_days: int = DEFAULT_TRAILING_DAYS
    top_n: int = DEFAULT_TOP_N


# Parameters that fit the driver's TPC-H-shaped tables (FIXTURES.md section 2).
FIXTURE_PARAMS = Params(deep_tier=10, named_categories=("PROMO", "STANDARD"),
                        weekly_target=7600000.0)
