"""Sinks: daily CSV drops, the raw parquet table, the cleaned CSV.

Writers never funnel data through one task: daily drops are
range-partitioned on (order_date, row_seq), so a day holding a third of
all rows is split over many tasks, and each task writes its own part file
per month.  File names carry the task number, so sorted path order is the
written order and a later ``read_daily_drop`` sees the same first copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.plans.versions import Store
from tillroll.schema import DROP_MONTH, ROW_SEQ
from tillroll.session import shuffle_files_removed
from tillroll.sources.lines import DIALECT

# As Python's csv module and pandas write: quotes doubled, blanks and line breaks kept.
WRITTEN = {**DIALECT, "header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

NO_MONTH = "__HIVE_DEFAULT_PARTITION__"      # the folder that Spark gives a null


def by_range(rows: DataFrame, place: list[str]) -> DataFrame:
    """Rows dealt to tasks in ranges of (order_date, place); their number is left to Spark (AQE)."""
    return rows.repartitionByRange("order_date", *place)


def by_day(rows: DataFrame, place: list[str]) -> DataFrame:
    """Rows dealt to tasks by day; AQE splits a hot one."""
    return rows.hint("rebalance", "order_date")


def write_daily_drop(raw: DataFrame, path: str, dealt: bool = False, compression: str = "none") -> str:
    """Write raw rows as a drop: ``order_month=YYYY-MM/part-*.csv`` with
    header, all columns inside the files, rows in first-copy order.

    A folder per month keeps the files few; a read of some days opens only
    their months.  ``dealt``: the rows come ``by_range`` already.  A compressed
    file is read by one task; it holds the part of one range at most.

    A partitioned write needs rows sorted by a folder column that is never
    null; were they not, Spark would sort by it alone and drop the sort below.
    """
    month = F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit(NO_MONTH))
    ordered = ((raw if dealt else by_range(raw, [ROW_SEQ])).withColumn(DROP_MONTH, month)
               .sortWithinPartitions(DROP_MONTH, "order_date", ROW_SEQ)
               .drop(ROW_SEQ))
    with shuffle_files_removed(raw.sparkSession):
        (ordered.write.mode("overwrite").options(**WRITTEN).option("compression", compression)
                .partitionBy(DROP_MONTH).csv(path))
    return path


def clustered(raw: DataFrame, dealt: bool = False) -> DataFrame:
    """Raw rows as the raw table holds them, clustered by (order_date, row_seq); ``dealt``: they come ``by_day`` already.

    ``REBALANCE(order_date)`` hash-distributes days over tasks and lets AQE
    split a day that holds a large share of the rows; unlike a range
    repartition it needs no sampling job, which would evaluate the whole
    upstream plan a second time.  Rows are sorted inside each file, so the
    parquet row-group statistics prune date filters.  ``row_seq`` is stored,
    so the first-copy order does not depend on file order.
    """
    return (raw if dealt else by_day(raw, [ROW_SEQ])).sortWithinPartitions("order_date", ROW_SEQ)


def write_raw_table(raw: DataFrame, path: str, dealt: bool = False) -> str:
    """Replace the raw table in the store ``path`` by a switch; the folder that is current now."""
    return Store(raw.sparkSession, path).replace("sales", clustered(raw, dealt))


def write_clean_csv(kept: DataFrame, path: str) -> str:
    """Kept orders as CSV with a header (a folder of part files)."""
    kept.write.mode("overwrite").options(**WRITTEN).csv(path)
    return path
