"""First copies kept up to date by a keyed merge.

The rows that the two cleaning orders need (``clean.first_copies``) are stored
in buckets by order_id.  A batch of new rows is cut to its own first copies;
those that are news (an order_id that is not stored, an earlier row_seq than
the stored ones, or a first copy that was not returned) name the buckets that
change.  Only these are read whole, merged and written to new folders; one
commit (``versions.py``) puts them in place of the old ones.  All other
buckets keep their files.

Rows are dealt to tasks once, in ranges of (bucket, hash of the order_id): an
id's copies then lie together, both rankings of ``clean.first_copies`` follow
without a further shuffle, and a task writes few buckets.  An order_id with
very many copies is cut to its first ones before.

The earlier row_seq wins whatever order batches come in, so after any batches
the store equals what one load of all files gives.  A batch that comes again
changes nothing.

A batch of all new order_ids still changes most buckets, as ids are spread by
hash; choose ``buckets`` so that one is about as large as a file should be.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.clean import first_copies
from tillroll.plans.versions import Store
from tillroll.schema import KEPT_FLAG, ROW_SEQ
from tillroll.session import remove_scratch, scratch_path, write_table

BUCKETS = 64
_BUCKET, _HASH = "_bucket", "_hash"
# An order_id is hot if it has so many copies and more than one of so many parts of all rows.
HOT_ROWS, HOT_PARTS = 10_000, 1_000
_CELLS = 10_000


class Merged(NamedTuple):
    """What a merge changed: buckets, and order dates whose first copies are other ones now."""

    buckets: set[str]
    days: set[date | None]


def _changed_buckets(mine: DataFrame, stored: DataFrame) -> set[str]:
    """Buckets in which a batch's first copies are news to the stored ones."""
    kept = F.col("return_flag") == KEPT_FLAG
    known = stored.groupBy("order_id").agg(F.min(ROW_SEQ).alias("_first"), F.min(F.when(kept, F.col(ROW_SEQ))).alias("_kept")) \
        .withColumnRenamed("order_id", "_id").withColumn("_known", F.lit(True))
    earlier = F.col("_known").isNull() | (F.col(ROW_SEQ) < F.col("_first"))
    news = mine.join(known, F.col("order_id").eqNullSafe(F.col("_id")), "left").filter(
        earlier | (kept & (F.col("_kept").isNull() | (F.col(ROW_SEQ) < F.col("_kept")))))
    return {str(r[0]) for r in news.select(_BUCKET).distinct().collect()}        # at most one row a bucket


def _changed_days(before: DataFrame | None, after: DataFrame) -> set[date | None]:
    """Dates of first copies that stand in one of two states only."""
    if before is None:
        return {r[0] for r in after.select("order_date").distinct().collect()}
    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select("order_id", "return_flag", ROW_SEQ, "is_first", "order_date", F.lit(sign).alias("_sign"))
    both = signed(after, 1).unionByName(signed(before, -1))
    other = both.groupBy("order_id", "return_flag", ROW_SEQ, "is_first", "order_date").agg(F.sum("_sign").alias("_sign"))
    return {r[0] for r in other.filter("_sign <> 0").select("order_date").distinct().collect()}     # a row a day


def _without_hot_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with the first copies alone of every hot order_id; ``rows`` are stored.

    Hot ids, fewer than ``HOT_PARTS``, are looked for in large cells of ids,
    so that counting moves a row per cell and task at most.
    """
    least = max(HOT_ROWS, rows.count() // HOT_PARTS)
    cell = F.pmod(F.xxhash64("order_id"), F.lit(_CELLS))
    large = [r[0] for r in rows.groupBy(cell.alias("cell")).count().filter(F.col("count") > least).collect()]
    if not large:
        return rows
    counts = rows.filter(cell.isin(large)).groupBy("order_id").count()
    hot = [r[0] for r in counts.filter(F.col("count") > least).collect()]
    if not hot:
        return rows
    key = F.col("order_id")
    is_hot = (key.isNull() & F.lit(None in hot)) | (key.isNotNull() & key.isin([k for k in hot if k is not None]))
    return rows.filter(~is_hot).unionByName(first_copies(rows.filter(is_hot)).drop("is_first"))


class FirstCopies:
    """The stored first copies of a growing drop."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.store = Store(spark, folder)

    def _folders(self) -> dict[str, str]:
        return self.store.version()["tables"].get("firsts", {})

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*sorted(folders))

    def read(self) -> DataFrame:
        """All first copies, in the form of ``clean.first_copies``; at least one batch was merged."""
        return self._read(list(self._folders().values()))

    def _first_copies(self, rows: DataFrame) -> DataFrame:
        """``clean.first_copies`` with their bucket, by one shuffle."""
        placed = rows.withColumn(_HASH, F.xxhash64("order_id")).withColumn(
            _BUCKET, F.pmod(_HASH, F.lit(self.buckets)).cast("int")).repartitionByRange(_BUCKET, _HASH)
        return first_copies(placed, [_BUCKET, _HASH, "order_id"]).drop(_HASH)

    def _write(self, firsts: DataFrame) -> dict[str, str]:
        folder = self.store.new_folder("firsts")
        write_table(firsts.sortWithinPartitions(_BUCKET, "order_id"), folder, by=[_BUCKET])
        return {name.split("=")[1]: f"{folder}/{name}" for name in self.store.names(folder) if name.startswith(_BUCKET)}

    def merge(self, batch: DataFrame, commit: str) -> Merged:
        """Bring a batch of raw rows, stored ones, in."""
        if self.store.version()["commit"] == commit:
            return Merged(set(), set())
        held = self._folders()
        mine = self._first_copies(_without_hot_copies(batch))
        if not held:
            new = self._write(mine)
            self.store.commit({"firsts": new}, commit)
            return Merged(set(new), _changed_days(None, self._read(list(new.values()))) if new else set())
        path = scratch_path(self.spark, "batch-firsts")
        write_table(mine, path)
        mine = self.spark.read.parquet(path)
        touched = {str(r[0]) for r in mine.select(_BUCKET).distinct().collect()}
        met = [held[k] for k in touched if k in held]
        changed = _changed_buckets(mine, self._read(met)) if met else touched
        new, days = {}, set()
        if changed:
            merged = mine.filter(F.col(_BUCKET).isin([int(k) for k in changed])).drop(_BUCKET, "is_first")
            old = [held[k] for k in changed if k in held]
            if old:
                merged = merged.unionByName(self._read(old).drop("is_first"))
            new = self._write(self._first_copies(merged))
            days = _changed_days(self._read(old) if old else None, self._read(list(new.values())))
        self.store.commit({"firsts": {**held, **new}}, commit)
        remove_scratch(self.spark, path)
        return Merged(set(new), days)
