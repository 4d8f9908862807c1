"""Blocked Bloom filters over 64-bit keys: Spark adds up the bits, tasks probe a broadcast copy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.words import mix

BITS_PER_KEY = 16
BLOCK_BITS = 512                 # all bits of a key lie in one block
PROBES = 6
BITMAP_BITS = 32768              # bits of one of Spark's bitmaps
PER_MAP = BITMAP_BITS // BLOCK_BITS
FILTER_BYTES = 64 << 20          # filter that is broadcast at once, at most

_U = np.uint64


def place(keys: np.ndarray, blocks) -> np.ndarray:
    """The block of each key, of ``blocks`` (a number or one per key)."""
    return (keys >> _U(32)) * _U(blocks) >> _U(32)


def key_bit(keys: np.ndarray, probe: int) -> np.ndarray:
    """The bit within its block that a key sets for one of its probes."""
    return ((mix(keys ^ _U(0xA24BAED4963EE407)) >> _U(9 * probe)) & _U(BLOCK_BITS - 1)).astype(np.int64)


def key_bits(keys: np.ndarray, block: np.ndarray) -> np.ndarray:
    """All bits that keys set, counted over the whole filter."""
    return np.concatenate([block.astype(np.int64) * BLOCK_BITS + key_bit(keys, p) for p in range(PROBES)])


def bitmaps(bits: DataFrame) -> DataFrame:
    """Rows of ``bit`` as (bucket from 1, map): Spark's own bitmap aggregates."""
    return bits.groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("map"))


def portion(maps: DataFrame, first: int, n: int) -> bytes:
    """``n`` bitmaps from the one numbered ``first`` (from 0), absent ones as zeros."""
    size = BITMAP_BITS // 8
    out = bytearray(n * size)
    for r in maps.filter(F.col("bucket").between(first + 1, first + n)).collect():           # n maps of 4 KB at most
        out[(r.bucket - 1 - first) * size:(r.bucket - first) * size] = r.map
    return bytes(out)


def hits(words: np.ndarray, keys: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Indices of keys that the filter (as 64-bit words) may hold, given each key's block in it."""
    at = np.arange(len(keys))
    for p in range(PROBES):
        bit = key_bit(keys[at], p)
        word = words[block[at].astype(np.int64) * (BLOCK_BITS // 64) + (bit >> 6)]
        at = at[(word >> (bit & 63).astype(_U)) & _U(1) == 1]
    return at


class Filter:
    """A filter over a column of keys, of at most ``limit`` bytes: with more keys it only lets more others pass."""

    def __init__(self, keys: DataFrame, column: str, limit: int = FILTER_BYTES):
        spark = keys.sparkSession
        maps_needed = -(-keys.count() * BITS_PER_KEY // BITMAP_BITS) or 1
        maps = min(maps_needed, max(1, limit * 8 // BITMAP_BITS))
        self.blocks = blocks = maps * PER_MAP

        def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                some = batch.column(0).to_numpy().view(_U)
                yield pa.RecordBatch.from_arrays([pa.array(key_bits(some, place(some, blocks)))], ["bit"])
        added = bitmaps(keys.select(column).mapInArrow(set_bits, "bit long"))
        self.held = spark.sparkContext.broadcast(portion(added, 0, maps))

    def hits(self, keys: np.ndarray) -> np.ndarray:
        return hits(np.frombuffer(self.held.value, _U), keys, place(keys, self.blocks))
