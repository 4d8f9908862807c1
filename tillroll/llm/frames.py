"""Moving whole columns through Spark in bounded slices.

Heavy per-word state crosses the shuffle as packed arrays: a task turns a
slice of rows into one row per target shard, so the JVM moves a few large
binary values instead of billions of small rows.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import remove_scratch, scratch_path, shuffle_files_removed

SLICE_BYTES = 8 << 20        # text handled at once by one task
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their workers may not have it on their path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tillroll-package-")) / "tillroll-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))           # Spark's own file server hands it out


def shuffle_partitions(spark: SparkSession) -> int:
    ship_package(spark)
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def arrow_bytes(spark: SparkSession, limit: int) -> Iterator[None]:
    """Writes within hand about ``limit`` bytes at once to a worker (one row at least): executor and worker hold a batch each."""
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, f"{limit}b")
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffle_files_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_tables(spark: SparkSession, *written: DataFrame | None) -> None:
    """Delete tables that ``write_scratch`` wrote and nothing reads any more."""
    for df in written:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()} if df is not None else ():
            remove_scratch(spark, folder)


def join_skewed(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame, parts: int = 1000) -> DataFrame:
    """Inner join on ``key``, which is unique in ``table``; ``counts`` (stored) has key and n, the ``rows`` of each key.

    Keys that hold more than one of ``parts`` of all rows, fewer than ``parts``
    of them therefore, are broadcast: their rows stay where they are.  All
    others meet by hash.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in counts.filter(F.col("n") * parts > F.lit(total)).select(key).collect()]     # below ``parts``
    if not hot:
        return rows.join(table, key)
    is_hot = F.col(key).isin(hot)
    return rows.filter(is_hot).join(F.broadcast(table.filter(is_hot)), key).unionByName(
        rows.filter(~is_hot).join(table.filter(~is_hot), key))


GRID = 32                        # blocks of a key on one side of a cell, about


def block_pairs(held: DataFrame, *carried: str) -> DataFrame:
    """left_block < right_block that hold a common key, from stored (key, block, ...), a row for each common key.

    ``carried`` columns of the blocks come as left_<name> and right_<name>.  A
    key of many blocks is cut in cells of about GRID x GRID blocks: no task
    ever lists all blocks of a key.
    """
    sides = write_scratch(held.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sides")
    cuts = sides.select("key", F.ceil(F.col("n") / GRID).cast("int").alias("cuts"))
    placed = join_skewed(held, cuts, "key", sides).withColumn("at", F.pmod(F.xxhash64("block"), F.col("cuts")))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))
    left = placed.select("key", F.col("at").alias("row"), others.alias("column"),
                         *[F.col(c).alias(f"left_{c}") for c in ("block", *carried)])
    right = placed.select("key", others.alias("row"), F.col("at").alias("column"),
                          *[F.col(c).alias(f"right_{c}") for c in ("block", *carried)])
    return left.join(right, ["key", "row", "column"]).filter("left_block < right_block")


def slices(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(low, high - low)
            low = high


def memory_returned(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, which at its end gives freed memory back to the system.

    Idle workers stay for a while beside those of the next stage, in the same executor's memory.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc alone keeps much of it, and has this
        if trim is not None:
            trim(0)
    return whole


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str,
               column: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over bounded slices of rows."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, column, limit):
            yield from fn(piece)
    return df.mapInArrow(memory_returned(run), schema)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; bytes of equal weight lie together, which compresses better."""
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(a.dtype.str[1:].encode().ljust(4) + np.array([len(a)], np.int64).tobytes())
        parts.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(value: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    out, at = [], 8
    for _ in range(int(np.frombuffer(raw, np.int64, 1)[0])):
        kind = np.dtype(raw[at:at + 4].decode().strip())
        n = int(np.frombuffer(raw, np.int64, 1, at + 4)[0])
        at += 12
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def delta(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def undelta(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=steps.dtype)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Range shard of a hash: sorted hashes give ascending shards."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def shard_bounds(sorted_hashes: np.ndarray, shards: int) -> np.ndarray:
    """shards + 1 offsets of the range shards in sorted hashes."""
    return np.searchsorted(shard_of(sorted_hashes, shards), np.arange(shards + 1))


def sort_order(values: np.ndarray) -> np.ndarray:
    """Indices that sort values of 0 to 2^64 - 1, equal ones in their order.

    One sort of plain numbers, upper bits of the value with its index behind:
    a few times faster than ``argsort``.  Only where values agree in the upper
    bits and differ below, which hashes hardly do, the rest is sorted after.
    """
    if not len(values):
        return np.zeros(0, np.int64)
    low = np.uint64((len(values) - 1).bit_length())
    packed = values.astype(np.uint64) << np.uint64(64 - max(1, int(values.max()).bit_length()))
    packed >>= low
    packed <<= low
    packed |= np.arange(len(values), dtype=np.uint64)
    packed.sort()
    packed &= (np.uint64(1) << low) - np.uint64(1)
    order = packed.view(np.int64)
    found = values[order]
    if (found[1:] < found[:-1]).any():
        order = order[np.argsort(found, kind="stable")]
    return order


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of 0 to 2^64 - 1, and the place of each value among them."""
    order = sort_order(values)
    found = values[order]
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(new) - 1
    return found[new], which


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint64, copy=False).view(np.int64)


def unsigned(longs: np.ndarray) -> np.ndarray:
    return longs.astype(np.int64, copy=False).view(np.uint64)
