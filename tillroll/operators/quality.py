"""Data-quality measures, column profile and overview of a raw drop.

Everything is one aggregation pass over the raw rows (partial aggregation
map-side, one row out), unpivoted afterwards on that single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import pct
from tillroll.schema import DQ_ISSUE_LABELS, RETURN_FLAG, ROW_SEQ


def _blank(c: str) -> Column:
    # Missing text is NULL or the empty string (a blank CSV field).
    return F.col(c).isNull() | (F.col(c) == "")


def dq_counts(raw: DataFrame) -> DataFrame:
    """One row: rows and the five issue counts.

    Duplicates follow pandas ``duplicated()``: every row whose order_id was
    already seen, where all NULL ids count as one id.
    """
    return raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_blank("customer_name")).alias("missing_names"),
        F.count_if(_blank("region")).alias("missing_region"),
        F.count_if(F.col("quantity") < 0).alias("negative_qty"),
        F.count_distinct("order_id").alias("_ids"),
        F.max(F.col("order_id").isNull().cast("int")).alias("_null_id"),
        F.count_if(F.col("return_flag") == RETURN_FLAG).alias("returns"),
    ).select("rows", "missing_names", "missing_region", "negative_qty",
             (F.col("rows") - F.col("_ids") - F.coalesce(F.col("_null_id"), F.lit(0)))
             .cast("bigint").alias("duplicates"),
             "returns")


def dq_measure(raw: DataFrame, issue: str) -> DataFrame:
    """One issue: affected rows and their percentage of all rows (1 place)."""
    c = dq_counts(raw)
    return c.select(F.col(issue).alias("affected_rows"),
                    pct(issue, "rows", 1).alias("pct_of_rows"))


ISSUES = list(zip(["missing_names", "missing_region", "negative_qty", "duplicates", "returns"],
                  DQ_ISSUE_LABELS))


def dq_report(raw: DataFrame) -> DataFrame:
    """All five issues from one pass: (position, issue, affected_rows, pct)."""
    c = dq_counts(raw)
    stacked = ", ".join(f"{i + 1}, '{label}', {col}" for i, (col, label) in enumerate(ISSUES))
    return (c.selectExpr("rows", f"stack({len(ISSUES)}, {stacked}) AS (position, issue, affected_rows)")
             .select(F.col("position").cast("int"), "issue", "affected_rows",
                     pct("affected_rows", "rows", 1).alias("pct_of_rows"))
             .orderBy("position"))


def dq_rows_removed(raw: DataFrame, deduped: DataFrame) -> DataFrame:
    """Raw rows, rows after dedup, rows removed, and both column counts."""
    raw_cols = len([c for c in raw.columns if c != ROW_SEQ])
    n_raw = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    n_dedup = deduped.agg(F.count(F.lit(1)).alias("clean_rows"))
    return (n_raw.select("raw_rows", n_dedup.select("clean_rows").scalar().alias("clean_rows"))
                 .select("raw_rows", "clean_rows",
                         (F.col("raw_rows") - F.col("clean_rows")).alias("rows_removed"),
                         F.lit(raw_cols).alias("raw_columns"),
                         F.lit(len(deduped.columns)).alias("clean_columns")))


def unparsed_report(raw: DataFrame) -> DataFrame:
    """Values of a scanned drop that did not convert, by column: (column_name, values, rows, example)."""
    fault = F.explode(f"{ROW_SEQ}.faults")
    return (raw.select(fault.alias("fault"))
               .select(F.substring_index("fault", "=", 1).alias("column_name"),
                       F.expr("substring(fault, locate('=', fault) + 1)").alias("text"))
               .groupBy("column_name")
               .agg(F.count(F.lit(1)).alias("values"), F.min("text").alias("example"))
               .orderBy("column_name"))


def dataset_overview(raw: DataFrame, files: int | None = None) -> DataFrame:
    """Files, rows, first and last order_date, number and list of columns.

    ``files`` is the number of source files, as ``daily_csv.source_files``
    counts them for a scanned drop (files without rows included); without it
    the number of distinct order dates (one file per day).
    """
    cols = [c for c in raw.columns if c != ROW_SEQ]
    return raw.agg(F.count_distinct("order_date").alias("files") if files is None
                   else F.lit(files).cast("long").alias("files"),
                   F.count(F.lit(1)).alias("rows"),
                   F.min("order_date").alias("first_date"),
                   F.max("order_date").alias("last_date"),
                   F.lit(len(cols)).alias("columns"),
                   F.lit(", ".join(cols)).alias("column_names"))


def column_profile(raw: DataFrame) -> DataFrame:
    """Per column: position, name, Spark type, missing count and percent
    (2 places, half to even).  Text counts NULL or '' as missing."""
    fields = [f for f in raw.schema.fields if f.name != ROW_SEQ]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        miss = _blank(f.name) if f.dataType.typeName() == "string" else F.col(f.name).isNull()
        aggs.append(F.count_if(miss).alias(f"_m{i}"))
    one = raw.agg(*aggs)
    stacked = ", ".join(f"{i + 1}, '{f.name}', '{f.dataType.simpleString()}', _m{i}"
                        for i, f in enumerate(fields))
    return (one.selectExpr("_rows", f"stack({len(fields)}, {stacked}) "
                                    "AS (position, column_name, data_type, missing_count)")
               .select(F.col("position").cast("int"), "column_name", "data_type",
                       "missing_count",
                       pct("missing_count", "_rows", 2, half_even=True).alias("missing_pct"))
               .orderBy("position"))


def preview_head(raw: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows in drop order (day file, then position)."""
    return (raw.orderBy("order_date", ROW_SEQ, "order_id").limit(n).drop(ROW_SEQ))
