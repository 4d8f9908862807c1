"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Shingles are ordered by how many different sets hold them, rare ones first
(ties by hash).  Two sets with Jaccard similarity >= t share a shingle among
the first ``n - ceil(t * n) + 1`` of each, so only those prefixes are joined.
A shingle of one set alone joins nothing: what crosses the second shuffle are
the repeated shingles only, and they are all that an intersection can hold.

Steps, each a Spark shuffle of packed arrays:

1. words -> distinct shingles per text -> range shards of the hash;
2. per shard: in how many sets is each shingle; repeated ones go back by set;
3. per set: rare-first order, prefix; sets whose prefix holds no repeated
   shingle are out;
4. sets that share prefix shingles form families; large families are split
   into blocks of alike set sizes, and each pair of blocks that shares a prefix
   shingle and whose sizes can link meets in one task.  There length, prefix with position, and suffix filters
   leave the pairs that are verified; each pair lies in one pair of blocks,
   so it is verified once.  A task gives back a forest of links and each
   set's number of links, never all pairs of a dense group.

Equal sets are one class from step 1 on: copies cost one row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.frames import (
    arrow_bytes, block_pairs, delta, join_skewed, map_slices, memory_returned, pack, shard_bounds, shard_of, shuffle_partitions,
    signed, slices, undelta, unpack, unsigned, write_scratch,
)
from tillroll.llm.words import shingle_sets

BLOCK = 48                       # sets per block of a family, about
BLOCK_SHINGLES = 1 << 17         # shingles per block, about
SUFFIX_BINS = 16
CROSS_AT_ONCE = 1 << 18          # matches expanded at once in a verification
SCAN_BYTES = 4 << 20             # text whose shingles a task holds at once
PAIR_BYTES = 4 << 20             # pairs of blocks handed to a verification at once; a pair holds up to 2 MB, about


@dataclass(frozen=True)
class Threshold:
    """similarity >= num / den, in integers."""

    num: int = 75
    den: int = 100

    def needed(self, n):
        """Least intersection with a set of n shingles."""
        return -(-self.num * n // self.den)

    def overlap(self, a, b):
        """Least intersection of sets of a and b shingles that link."""
        return -(-self.num * (a + b) // (self.num + self.den))


def _scan(width: int, shards: int):
    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        h, t, sizes, digests = shingle_sets(piece.column("text"), width)
        ids = piece.column("doc_id")
        rows = [(int(digests[0] >> np.uint64(32)) * shards >> 32, 0, pack(
            ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
            np.asarray(ids.is_valid()).astype(np.uint8), sizes.astype(np.int32), signed(digests)))]
        classes, where, which = np.unique(digests, return_index=True, return_inverse=True)
        is_first = np.zeros(len(sizes), dtype=bool)
        is_first[where] = True
        mine = is_first[t]
        h, c = h[mine], which[t[mine]]
        bounds = shard_bounds(h, shards)
        for s in np.flatnonzero(np.diff(bounds)):
            part = slice(bounds[s], bounds[s + 1])
            used, local = np.unique(c[part], return_inverse=True)
            rows.append((int(s), 1, pack(delta(h[part]), local.astype(np.uint32), delta(classes[used]),
                                         sizes[where[used]].astype(np.int32))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.binary())], ["shard", "kind", "payload"])
    return run


def _count(shards: int):
    """Per shard: repeated shingles go on to the shard of their set; rows of documents pass through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, ds, ns = [], [], []
        for batch in batches:
            for kind, payload in zip(batch.column("kind").to_pylist(), batch.column("payload")):
                if kind == 0:
                    yield _rows([(0, 0, payload.as_py())])
                    continue
                h, local, digests, sizes = unpack(payload.as_py())
                hs.append(undelta(h))
                ds.append(undelta(digests)[local])
                ns.append(sizes[local])
        if not hs:
            return
        h, d, n = np.concatenate(hs), np.concatenate(ds), np.concatenate(ns)
        del hs, ds, ns
        order = np.argsort(h, kind="stable")
        h = h[order]
        same = h[1:] == h[:-1]
        again = np.zeros(len(h), dtype=bool)      # the hash stands next to itself: alone it joins nothing
        again[1:] |= same
        again[:-1] |= same
        h, order = h[again], order[again]
        d, n = d[order], n[order]
        order = np.lexsort((d, h))
        h, d, n = h[order], d[order], n[order]
        keep = np.ones(len(h), dtype=bool)
        keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, d, n = h[keep], d[keep], n[keep]
        _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        many = counts[inverse]
        keep = many >= 2
        h, d, n, many = h[keep], d[keep], n[keep], many[keep]
        order = np.argsort(d, kind="stable")
        h, d, n, many = h[order], d[order], n[order], many[order]
        bounds = shard_bounds(d, shards)
        for s in np.flatnonzero(np.diff(bounds)):
            part = slice(bounds[s], bounds[s + 1])
            yield _rows([(int(s), 1, pack(delta(d[part]), n[part], h[part], many[part].astype(np.int64)))])
    return run


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.binary())], ["shard", "kind", "payload"])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch.column("payload"):
            ids, valid, sizes, digests = unpack(payload.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=valid == 0), pa.array(sizes.astype(np.int64)),
                 pa.array(digests, mask=sizes == 0)], ["doc_id", "n_shingles", "digest"])


def _prefixes(threshold: Threshold):
    """Per set: its repeated shingles rare-first; out if no repeated one lies in the prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [unpack(p.as_py()) for batch in batches for p in batch.column("payload")]
        if not parts:
            return
        d = np.concatenate([undelta(p[0]) for p in parts])
        n, h, many = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        del parts
        order = np.lexsort((h, many, d))
        d, n, h = d[order], n[order].astype(np.int64), h[order]
        first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        ends = np.append(first[1:], len(d))
        size = n[first]
        alone = size - (ends - first)
        prefix = np.minimum(size - threshold.needed(size) + 1 - alone, ends - first)
        out = np.flatnonzero(prefix > 0)
        for low in range(0, len(out), 256):
            some = out[low:low + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(d[first[some]])), pa.array(size[some]), pa.array(alone[some]),
                 pa.array(prefix[some]),
                 pa.array([h[first[i]:ends[i]].tobytes() for i in some], pa.binary())],
                ["digest", "size", "alone", "prefix", "shingles"])
    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shingle of a prefix."""
    for batch in batches:
        prefix = batch.column("prefix").to_numpy()
        flat = [np.frombuffer(s.as_buffer(), np.int64, p) for s, p in zip(batch.column("shingles"), prefix)]
        if flat:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(flat)), pa.array(np.repeat(batch.column("digest").to_numpy(), prefix))],
                ["hash", "digest"])


class _Block:
    """Sets of one block as flat arrays."""

    def __init__(self, members):
        members = sorted(members, key=lambda m: m["digest"])
        self.digest = np.array([m["digest"] for m in members], np.int64)
        self.size = np.array([m["size"] for m in members], np.int64)
        self.alone = np.array([m["alone"] for m in members], np.int64)
        self.prefix = np.array([m["prefix"] for m in members], np.int64)
        self.copies = np.array([m["copies"] for m in members], np.int64)
        lists = [np.frombuffer(m["shingles"], np.uint64) for m in members]
        self.hash = np.concatenate(lists)
        counts = np.array([len(x) for x in lists])
        self.owner = np.repeat(np.arange(len(lists)), counts)
        self.rank = np.arange(len(self.hash)) - np.repeat(np.cumsum(counts) - counts, counts)
        bins = (self.hash >> np.uint64(60)).astype(np.int64)
        self.bins = np.bincount(self.owner * SUFFIX_BINS + bins,
                                minlength=len(lists) * SUFFIX_BINS).reshape(-1, SUFFIX_BINS)


def _matches(a: _Block, b: _Block, use_a: np.ndarray, use_b: np.ndarray):
    """Pairs of entries with equal hashes, in bounded portions."""
    ia, ib = np.flatnonzero(use_a), np.flatnonzero(use_b)
    ia = ia[np.argsort(a.hash[ia], kind="stable")]
    ib = ib[np.argsort(b.hash[ib], kind="stable")]
    low = np.searchsorted(b.hash[ib], a.hash[ia], side="left")
    high = np.searchsorted(b.hash[ib], a.hash[ia], side="right")
    n = high - low
    have = np.flatnonzero(n)
    ends = np.cumsum(n[have])
    at = 0
    while at < len(have):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CROSS_AT_ONCE, side="right")))
        some = have[at:stop]
        k = n[some]
        within = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        yield np.repeat(ia[some], k), ib[np.repeat(low[some], k) + within]
        at = stop


def links_between(a: _Block, b: _Block, threshold: Threshold, same: bool) -> np.ndarray:
    """Boolean matrix of linked sets of two blocks (above the diagonal if they are the same)."""
    shape = (len(a.size), len(b.size))
    need = threshold.overlap(a.size[:, None], b.size[None, :])
    small = np.minimum(a.size[:, None], b.size[None, :])
    large = np.maximum(a.size[:, None], b.size[None, :])
    alive = threshold.den * small >= threshold.num * large                  # length filter
    if same:
        alive &= np.triu(np.ones(shape, dtype=bool), 1)
    # Prefix filter with positions: behind the last shared prefix shingle at most the shorter rest is shared.
    shared = np.zeros(shape[0] * shape[1], np.int64)
    last_a, last_b = np.zeros_like(shared), np.zeros_like(shared)
    for i, j in _matches(a, b, a.rank < a.prefix[a.owner], b.rank < b.prefix[b.owner]):
        cell = a.owner[i] * shape[1] + b.owner[j]
        shared += np.bincount(cell, minlength=len(shared))
        np.maximum.at(last_a, cell, a.rank[i] + 1)
        np.maximum.at(last_b, cell, b.rank[j] + 1)
    shared, last_a, last_b = (x.reshape(shape) for x in (shared, last_a, last_b))
    rest_a = a.size[:, None] - a.alone[:, None] - last_a
    rest_b = b.size[None, :] - b.alone[None, :] - last_b
    alive &= (shared > 0) & (shared + np.minimum(rest_a, rest_b) >= need)
    # Suffix filter: the shared part is at most the sum over hash ranges of the smaller count.
    i, j = np.nonzero(alive)
    for low in range(0, len(i), 1 << 16):
        p, q = i[low:low + (1 << 16)], j[low:low + (1 << 16)]
        most = np.minimum(a.bins[p], b.bins[q]).sum(axis=1)
        alive[p, q] = most >= need[p, q]
    # Verification.
    both = np.zeros(shape[0] * shape[1], np.int64)
    for i, j in _matches(a, b, alive.any(axis=1)[a.owner], alive.any(axis=0)[b.owner]):
        both += np.bincount(a.owner[i] * shape[1] + b.owner[j], minlength=len(both))
    both = both.reshape(shape)
    return alive & (threshold.den * both >= threshold.num * (a.size[:, None] + b.size[None, :] - both))


def _forest(i: np.ndarray, j: np.ndarray) -> list[int]:
    """Indices of links that connect something new."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    out = []
    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append(k)
    return out


def _verify(threshold: Threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                same = bool(batch.column("same")[row].as_py())
                a = _Block(batch.column("left")[row].as_py())
                b = a if same else _Block(batch.column("right")[row].as_py())
                linked = links_between(a, b, threshold, same)
                i, j = np.nonzero(linked)
                if not len(i):
                    continue
                da, db = a.digest[i], b.digest[j]
                tree = _forest(da, db)
                ends = np.concatenate([da, db])
                gains = np.concatenate([b.copies[j], a.copies[i]])
                keys, which = np.unique(ends, return_inverse=True)
                degree = np.bincount(which, weights=gains).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([da[tree], keys])),
                     pa.array(np.concatenate([db[tree], keys])),
                     pa.array(np.concatenate([np.zeros(len(tree), np.int64), degree]))], ["u", "v", "degree"])
    return run


def jaccard_join(docs: DataFrame, width: int = 5, threshold: Threshold = Threshold(),
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links.

    Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set is
    its distinct runs of ``width`` words (all words as one, if fewer).  Two
    documents link if the sets' Jaccard similarity reaches ``threshold``.
    ``component_id`` is the smallest doc_id reachable by links, ``n_links``
    the number of other rows that the row links with, copies included.

    Null and empty texts, and texts of white space alone, have 0 shingles, no
    links and their own id.  Repeated rows link with each other and each
    gives a row.  A null doc_id is never a component_id while another id is
    reachable.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    shards = shuffle_partitions(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed = "shard int, kind int, payload binary"
    scanned = map_slices(texts, _scan(width, shards), packed, limit=SCAN_BYTES)
    counted = write_scratch(
        scanned.repartitionById(shards, F.col("shard")).mapInArrow(memory_returned(_count(shards)), packed), "shingles")
    rows = counted.filter("kind = 0").mapInArrow(_documents, "doc_id long, n_shingles long, digest long")
    sets = write_scratch(
        counted.filter("kind = 1").repartitionById(shards, F.col("shard")).mapInArrow(
            memory_returned(_prefixes(threshold)), "digest long, size long, alone long, prefix long, shingles binary"), "sets")
    entries = sets.mapInArrow(_entries, "hash long, digest long")

    hubs = write_scratch(entries.groupBy("hash").agg(F.min("digest").alias("v"), F.count(F.lit(1)).alias("n"))
                         .filter("n > 1"), "hubs")
    edges = join_skewed(entries, hubs.select("hash", "v"), "hash", hubs).select(F.col("digest").alias("u"), "v").distinct()
    family = components(edges).select(F.col("node").alias("digest"), "root").join(sets.select("digest", "size"), "digest")
    # Sets of one band are of alike sizes: in a large family, bands that cannot link never meet.
    band = F.floor(F.log("size") / F.log(F.lit(threshold.den / threshold.num)))
    large = family.groupBy("root").agg((F.count(F.lit(1)) > BLOCK).alias("large"))
    banded = family.join(large, "root").withColumn("band", F.when(F.col("large"), band).otherwise(-1))
    counts = banded.groupBy("root", "band").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_SHINGLES)).alias("blocks"))
    placed = write_scratch(banded.join(counts, ["root", "band"]).select(
        "digest", "size", F.xxhash64("root", "band", F.pmod(F.xxhash64("digest"), "blocks")).alias("block")), "blocks")

    copies = write_scratch(rows.filter("digest is not null").groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("low")), "copies")
    members = sets.join(placed.select("digest", "block"), "digest").join(copies.select("digest", "copies"), "digest") \
        .groupBy("block").agg(F.collect_list(F.struct("digest", "size", "alone", "prefix", "copies", "shingles")).alias("members"))
    reach = placed.groupBy("block").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    held = write_scratch(entries.join(placed.select("digest", "block"), "digest").select(F.col("hash").alias("key"), "block")
                         .distinct().join(reach, "block"), "blocks-of-hashes")
    across = block_pairs(held, "least", "most").filter(
        (threshold.den * F.col("left_most") >= threshold.num * F.col("right_least"))
        & (threshold.den * F.col("right_most") >= threshold.num * F.col("left_least"))) \
        .select("left_block", "right_block").distinct()
    pairs = reach.select(F.col("block").alias("left_block"), F.col("block").alias("right_block")).unionByName(across)
    left = members.select(F.col("block").alias("left_block"), F.col("members").alias("left"))
    right = members.select(F.col("block").alias("right_block"), F.col("members").alias("right"))
    met = pairs.join(left, "left_block").join(right, "right_block").select(
        "left", "right", (F.col("left_block") == F.col("right_block")).alias("same"))
    with arrow_bytes(spark, PAIR_BYTES):
        found = write_scratch(met.mapInArrow(memory_returned(_verify(threshold)), "u long, v long, degree long"), "links")

    linked = components(found.filter("u <> v").select("u", "v"))
    degrees = found.filter("degree > 0").groupBy(F.col("u").alias("digest")).agg(F.sum("degree").alias("degree"))
    named = write_scratch(copies.join(linked.select(F.col("node").alias("digest"), "root"), "digest", "left")
                          .join(degrees, "digest", "left").withColumn("root", F.coalesce("root", "digest")), "named")
    smallest = write_scratch(named.groupBy("root").agg(F.min("low").alias("component"), F.count(F.lit(1)).alias("n")), "smallest")
    classes = write_scratch(join_skewed(named, smallest.select("root", "component"), "root", smallest).select(
        "digest", "component", F.col("copies").alias("n"),
        (F.col("copies") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links")), "classes")
    joined = join_skewed(rows.filter("digest is not null"), classes.select("digest", "component", "n_links"), "digest", classes)
    joined = joined.unionByName(rows.filter("digest is null"), allowMissingColumns=True)
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                         F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
