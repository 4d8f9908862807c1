"""Cleaning: default filling, sign repair, keep-first dedup, revenue, splits.

Two cleaning orders exist and both are kept:

* ``sales_clean`` (the SQL view): drop returns first, then keep the first
  copy of each order_id among the remaining rows;
* ``dedup_clean`` (EDA and statistics): keep the first copy over all rows,
  then split into kept orders and returns.

"First" follows the source's ``row_seq`` column (file order, then position
in the file).  The dedup is a ``row_number() == 1`` window partitioned by
order_id; Spark plans it as a WindowGroupLimit that already keeps one row
per order_id and map partition before the shuffle, so a hot order_id with
millions of copies never reaches a reducer whole.

``first_copies`` keeps the rows that either order needs, flat and once each;
the load stores them, so both views are filters over one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.money import gross_revenue, line_revenue
from tillroll.schema import (KEPT_FLAG, RETURN_FLAG, ROW_SEQ, SALES_COLUMNS,
                             UNKNOWN_CUSTOMER, UNKNOWN_REGION)


def fill_defaults(df: DataFrame, customer_default: str = UNKNOWN_CUSTOMER,
                  region_default: str = UNKNOWN_REGION) -> DataFrame:
    """Blank or missing customer_name / region become a named bucket."""
    return df.withColumns({
        "customer_name": F.coalesce(F.nullif(F.col("customer_name"), F.lit("")),
                                    F.lit(customer_default)),
        "region": F.coalesce(F.nullif(F.col("region"), F.lit("")), F.lit(region_default)),
    })


def abs_quantity(df: DataFrame) -> DataFrame:
    """Negative quantities are entry errors: keep the magnitude."""
    return df.withColumn("quantity", F.abs(F.col("quantity")))


def derive_revenue(df: DataFrame) -> DataFrame:
    """revenue = unit_price x quantity x (1 - discount_pct / 100), exact."""
    return df.withColumn("revenue", line_revenue("unit_price", "quantity", "discount_pct"))


def derive_gross_discount(df: DataFrame) -> DataFrame:
    """gross_revenue = price x quantity; discount_amount = gross - revenue."""
    return (df.withColumn("gross_revenue", gross_revenue("unit_price", "quantity"))
              .withColumn("discount_amount", F.col("gross_revenue") - F.col("revenue")))


def keep_first(df: DataFrame, key: str = "order_id", order: str = ROW_SEQ) -> DataFrame:
    """Keep the first row of each ``key`` in ``order`` (pandas keep='first')."""
    w = Window.partitionBy(key).orderBy(F.col(order).asc())
    return (df.withColumn("_copy", F.row_number().over(w))
              .filter(F.col("_copy") == 1)
              .drop("_copy"))


def split_kept(df: DataFrame) -> DataFrame:
    return df.filter(F.col("return_flag") == KEPT_FLAG)


def split_returns(df: DataFrame) -> DataFrame:
    return df.filter(F.col("return_flag") == RETURN_FLAG)


def drop_unknown_region(df: DataFrame, region_default: str = UNKNOWN_REGION) -> DataFrame:
    return df.filter(F.col("region") != region_default)


def sales_clean(raw: DataFrame) -> DataFrame:
    """The cleaning view: returns dropped, first copy kept, revenue added."""
    kept_first = keep_first(split_kept(raw))
    cleaned = derive_revenue(abs_quantity(fill_defaults(kept_first)))
    return cleaned.select(*SALES_COLUMNS, "revenue")


def dedup_clean(raw: DataFrame, with_gross: bool = False) -> DataFrame:
    """EDA cleaning: fill, abs, keep first copy over all rows, revenue."""
    cleaned = derive_revenue(keep_first(abs_quantity(fill_defaults(raw))))
    cols = [*SALES_COLUMNS, "revenue"]
    if with_gross:
        cleaned = derive_gross_discount(cleaned)
        cols += ["gross_revenue", "discount_amount"]
    return cleaned.select(*cols)


def kept_orders(raw: DataFrame, with_gross: bool = False) -> DataFrame:
    """Deduplicated orders that were not returned (``df_sales``)."""
    return split_kept(dedup_clean(raw, with_gross))


def returned_orders(raw: DataFrame) -> DataFrame:
    """Deduplicated orders that were returned (``df_returns``)."""
    return split_returns(dedup_clean(raw))


def product_label(df: DataFrame, out: str = "label") -> DataFrame:
    """"name (sku)" label of a product."""
    return df.withColumn(out, F.format_string("%s (%s)", F.col("product_name"),
                                              F.col("sku_id").cast("string")))


def first_copies(raw: DataFrame, key: str | list[str] = "order_id", order: str | list[str] = ROW_SEQ) -> DataFrame:
    """Flat rows that serve both cleaning orders, with ``is_first``.

    One row per (key, return_flag) survives: its first copy.  Among the few
    survivors of a key the first is marked, which is the first copy over all
    rows; the survivor that is not returned is the first kept copy.  Rows that
    are neither are left out.  The first ranking keeps one row per group and
    map partition before the shuffle (a partial WindowGroupLimit), so a hot
    key shrinks there; the second sees the survivors alone, a row per flag,
    and needs no further sort.  Rows that lie together by a column of ``key``
    already (joined by it, for example) are not shuffled.
    """
    keys, orders = ([c] if isinstance(c, str) else list(c) for c in (key, order))
    copy = F.row_number().over(Window.partitionBy(*keys, "return_flag").orderBy(*orders))
    survivors = raw.withColumn("_copy", copy).filter(F.col("_copy") == 1).drop("_copy")
    place = F.struct(*orders, "return_flag")             # distinct among the survivors of a key
    return (survivors.withColumn("is_first", place.eqNullSafe(F.min(place).over(Window.partitionBy(*keys))))
                     .filter(F.col("is_first") | (F.col("return_flag") == KEPT_FLAG)))


def first_rows(firsts: DataFrame) -> DataFrame:
    """The first copy of every key over all rows."""
    return firsts.filter("is_first").drop("is_first")


def first_kept_rows(firsts: DataFrame) -> DataFrame:
    """The first copy of every key among rows that were not returned."""
    return split_kept(firsts).drop("is_first")


def sales_clean_from_firsts(firsts: DataFrame) -> DataFrame:
    """The cleaning view from ``first_copies`` output."""
    cleaned = derive_revenue(abs_quantity(fill_defaults(first_kept_rows(firsts))))
    return cleaned.select(*SALES_COLUMNS, "revenue")


def dedup_clean_from_firsts(firsts: DataFrame, with_gross: bool = False) -> DataFrame:
    """EDA cleaning (keep first over all rows) from ``first_copies`` output."""
    cleaned = derive_revenue(abs_quantity(fill_defaults(first_rows(firsts))))
    cols = [*SALES_COLUMNS, "revenue"]
    if with_gross:
        cleaned = derive_gross_discount(cleaned)
        cols += ["gross_revenue", "discount_amount"]
    return cleaned.select(*cols)
