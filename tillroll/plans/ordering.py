"""Rank, running sums and previous-row lookups without a global window.

``rank() OVER (ORDER BY x)`` and ``SUM(...) OVER (ORDER BY x)`` with no
PARTITION BY make Spark move every row into one task.  That is harmless for
ten salespeople and fatal for a billion.  ``ordered_rows`` computes the same
numbers as a two-level prefix sum over the rows themselves:

1. range-partition the rows by the order value and keep that result
   (``persist``), so that both branches below use one partitioning and the
   fact table behind the rows is read once; equal values share a partition;
2. per-partition totals -> prefix offsets over the partitions (one row per
   shuffle partition, a bounded, tiny table that is broadcast back);
3. within each partition a window partitioned by partition id gives the
   prefix inside the partition, and the offset is added.

The rows are grouped rows, far fewer than facts.  Persisting writes nothing
when a query is built; a lost block is computed again with the same range
bounds, which the shuffle's partitioner holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sort_key(col: str, descending: bool) -> Column:
    # SQL defaults: NULLs sort first ascending and last descending.
    return F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_first()


def ordered_rows(df: DataFrame, order_col: str, *, descending: bool = False,
                 sums: Sequence[str] = (), previous: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``_before_n``, the rows whose ``order_col`` lies strictly
    before, and for each column ``c`` in ``sums`` ``_before_c``, its sum over
    them, and ``_total_c``, its sum over all rows.  For ``c`` in ``previous``
    (distinct order values, ascending) ``_prev_c`` is ``c`` of the row before.
    """
    if previous and descending:
        raise ValueError("previous values are only defined for ascending scans")
    key = _sort_key(order_col, descending)
    ranged = df.repartitionByRange(key).withColumn("_part", F.spark_partition_id()) \
        .persist(StorageLevel.MEMORY_AND_DISK)

    # The last value of a partition in sort order (NULL keys sort first).
    last_key = F.struct(F.col(order_col).isNotNull(), F.col(order_col))
    totals = ranged.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums],
        *[F.max_by(F.col(c), last_key).alias(f"_last_{c}") for c in previous])
    # One row per shuffle partition: bounded by configuration, not by data.
    by_part = Window.orderBy("_part")
    earlier_parts = by_part.rowsBetween(Window.unboundedPreceding, -1)
    all_parts = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_n").over(earlier_parts), F.lit(0)).alias("_off_n"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier_parts), F.lit(0)).alias(f"_off_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(all_parts).alias(f"_total_{c}") for c in sums],
        *[F.lag(f"_last_{c}").over(by_part).alias(f"_plast_{c}") for c in previous])

    in_part = Window.partitionBy("_part").orderBy(key)
    # Peers (equal order values) are not before each other.
    through_peers = in_part.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own_peers = Window.partitionBy("_part", order_col)
    within = ranged.select(
        *df.columns, "_part", (F.rank().over(in_part) - 1).alias("_in_n"),
        *[(F.sum(c).over(through_peers) - F.sum(c).over(own_peers)).alias(f"_in_{c}") for c in sums],
        *[F.lag(c).over(in_part).alias(f"_inlag_{c}") for c in previous])
    return within.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_off_n") + F.col("_in_n")).alias("_before_n"),
        *[(F.col(f"_off_{c}") + F.coalesce(F.col(f"_in_{c}"), F.lit(0))).alias(f"_before_{c}") for c in sums],
        *[f"_total_{c}" for c in sums],
        *[F.when(F.col("_in_n") == 0, F.col(f"_plast_{c}")).otherwise(F.col(f"_inlag_{c}")).alias(f"_prev_{c}")
          for c in previous])


def with_rank(df: DataFrame, value: str, out: str = "rank", descending: bool = True,
              total: str | None = None) -> DataFrame:
    """Add ``rank() OVER (ORDER BY value [DESC])`` (ties share, gaps follow)
    and, if named, the ``total`` of ``value`` over all rows."""
    scan = ordered_rows(df, value, descending=descending, sums=[value] if total else [])
    extra = [F.col(f"_total_{value}").alias(total)] if total else []
    return scan.select(*df.columns, (F.col("_before_n") + 1).alias(out), *extra)


def with_sequence(df: DataFrame, order_col: str, value: str, *, index: str = "_idx",
                  running: str | None = None, previous: str | None = None) -> DataFrame:
    """For rows with distinct ``order_col`` values (e.g. one row per date):
    0-based position ``index``, optional running total of ``value``
    (``SUM(value) OVER (ORDER BY order_col)``) and optional ``previous``
    value (``LAG(value)``, NULL on the first row).
    """
    scan = ordered_rows(df, order_col, sums=[value] if running else [], previous=[value] if previous else [])
    cols = [F.col("_before_n").alias(index)]
    if running:
        cols.append((F.col(f"_before_{value}") + F.col(value)).alias(running))
    if previous:
        cols.append(F.col(f"_prev_{value}").alias(previous))
    return scan.select(*df.columns, *cols)


def grouped_totals(grouped: DataFrame, *values: str) -> dict[str, Column]:
    """Sums of columns of grouped rows over all groups, as one scalar subquery.

    The grouped rows are persisted: the subquery and the caller's own plan,
    pruned differently, would otherwise each scan and group the facts.
    """
    grouped.persist(StorageLevel.MEMORY_AND_DISK)
    scalar = grouped.agg(F.struct(*[F.sum(v).alias(v) for v in values]).alias("t")).scalar()
    return {v: scalar[v] for v in values}
