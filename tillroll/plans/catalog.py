"""Register a drop's frames as SQL views so users can run their own SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.schema import ROW_SEQ


def register_views(spark: SparkSession, drop, prefix: str = "") -> list[str]:
    """Views ``sales`` (raw), ``sales_clean`` (the view), ``targets``,
    ``sales_kept`` and ``sales_returns`` (dedup, then split)."""
    views = {"sales": drop.raw.drop(ROW_SEQ), "sales_clean": drop.clean,
             "targets": drop.targets, "sales_kept": drop.kept, "sales_returns": drop.returns}
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]


def read_query(spark: SparkSession, sql: str) -> DataFrame:
    """Run SQL text against the registered views (lazy)."""
    return spark.sql(sql)
