"""Near duplicates by MinHash bands and sequential Bayesian verification.

1. Each text's set of distinct word shingles gives a digest and 96 minima;
   equal sets are one class from here on.
2. 24 bands of four minima are the keys on which classes meet.  Two sets of
   similarity 0.85 share none with probability 2e-8.
3. In each key, the class of the smallest digest is the hub; every class is
   verified against the hubs of its keys.  The smallest hub that a class links
   with is its label, so classes of one label are connected: a large group of
   near copies gets one label here, by a number of pairs that is linear in it.
4. Keys that still hold several labels: their classes are put in blocks, and
   the pairs of blocks that share a key and are not of one label meet in one
   task each.  There all pairs that share a key are verified, unless links
   already found connect them.

A pair is verified in steps.  After each batch of 16 minima the posterior of
its similarity (uniform prior, binomial matches) is looked at: the pair is
pruned when the chance that it reaches the threshold falls below
``MISS`` = 1e-6.  Pairs that survive all batches are counted on the full sets,
and only that count makes a link.  The sets are not kept for all texts: a
second pass makes those of classes that may be counted, picked by a broadcast
Bloom filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bloom import Filter
from tillroll.llm.components import Forest, components
from tillroll.llm.frames import block_pairs, join_skewed, map_slices, ship_package, signed, write_scratch
from tillroll.llm.words import mix, shingle_sets

BANDS, ROWS = 24, 4
MINIMA = BANDS * ROWS
BATCH = 16
MISS = 1e-6
BLOCK = 48                       # classes of a block, about
BLOCK_SHINGLES = 1 << 17         # shingles of a block, about
PARTS = 2000                     # a class in more than this part of all pairs is dealt to several tasks
CHUNK = 1 << 15
SLICE = 2 << 20                  # bytes of text handled at once

_U = np.uint64
_FLIP = mix(np.arange(1, MINIMA + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
_TIMES = mix(_FLIP ^ _U(0x5DEECE66D)) | _U(1)


def minima(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """texts x MINIMA: the least value of every hash function over each text's hashes; texts without any are left out."""
    filled = np.flatnonzero(np.diff(first))
    starts = first[:-1][filled]
    out = np.empty((len(filled), MINIMA), np.uint32)
    low = 0
    while low < len(filled):                     # whole texts, about CHUNK hashes: they stay in the cache
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + CHUNK)))
        end = starts[high] if high < len(filled) else len(hashes)
        part, cuts = hashes[starts[low]:end], starts[low:high] - starts[low]
        for k in range(MINIMA):
            out[low:high, k] = np.minimum.reduceat((part ^ _FLIP[k]) * _TIMES[k], cuts) >> _U(32)
        low = high
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """sets x BANDS keys of a matrix of signatures."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(_U)
    keys = np.zeros((len(signatures), BANDS), _U)
    for k in range(ROWS):
        keys = mix(keys * _U(0x9E3779B97F4A7C15) + rows[:, :, k])
    return mix(keys + np.arange(BANDS, dtype=_U))


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(n, m) per batch: with fewer than m matches in n minima, similarity >= threshold is less likely than ``miss``.

    The posterior of the similarity is Beta(m + 1, n - m + 1); its upper tail
    is the chance of at most m successes in n + 1 trials.
    """
    out = []
    for n in range(BATCH, MINIMA + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def probable(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Indices of the pairs of signatures (rows of a and b) that no batch rules out."""
    alive, matches, low = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, m in steps:
        matches = matches + (a[alive, low:n] == b[alive, low:n]).sum(axis=1)
        alive, matches, low = alive[matches >= m], matches[matches >= m], n
    return alive


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets reach the similarity num / den."""
    if den * min(len(a), len(b)) < num * max(len(a), len(b)):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return den * both >= num * (len(a) + len(b) - both)


def _firsts(piece: pa.RecordBatch, width: int, wanted: Filter | None = None):
    """Sizes and digests of a slice's texts, which texts are the first of their set, and these sets' hashes, flat."""
    h, t, sizes, digests = shingle_sets(piece.column("text"), width)
    _, where = np.unique(digests, return_index=True)
    is_first = np.zeros(len(sizes), dtype=bool)                  # a copy within the slice needs no second set
    is_first[where if wanted is None else where[wanted.hits(digests[where])]] = True
    is_first &= sizes > 0
    h, t = h[is_first[t]], t[is_first[t]]
    h = h[np.argsort(t, kind="stable")]
    return sizes, digests, is_first, h, np.concatenate([[0], np.cumsum(np.where(is_first, sizes, 0))])


def _scan(width: int):
    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, digests, is_first, h, first = _firsts(piece, width)
        signatures = iter(minima(h, first))
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(signed(digests), mask=sizes == 0),
             pa.array([next(signatures).tobytes() if f else None for f in is_first], pa.binary())],
            ["doc_id", "n_shingles", "digest", "signature"])
    return run


def _sets(width: int, wanted: Filter):
    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        _, digests, is_first, h, first = _firsts(piece, width, wanted)
        at = np.flatnonzero(is_first)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(digests[at])), pa.array([m.tobytes() for m in minima(h, first)], pa.binary()),
             pa.array([h[first[k]:first[k + 1]].tobytes() for k in at], pa.binary())],
            ["digest", "signature", "shingles"])
    return run


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, MINIMA)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class and band."""
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(_signatures(batch.column("signature")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(keys.reshape(-1))), pa.array(np.repeat(batch.column("digest").to_numpy(), BANDS))],
                ["key", "digest"])


def _pairs_probable(steps):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive = probable(_signatures(batch.column("left")), _signatures(batch.column("right")), steps)
                yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in ("u", "v")], ["u", "v"])
    return run


def _pairs_linked(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U), num, den)
                    for a, b in zip(batch.column("left"), batch.column("right"))]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return run


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list[dict]]]:
    """Both blocks of each cell, or the only one; the rows of a cell lie together, in one batch or in two."""
    cell, sides = None, []
    for batch in batches:
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            this = row["left_block"], row["right_block"]
            if this != cell:
                if sides:
                    yield sides
                cell, sides = this, []
            sides.append(row["members"])
    if sides:
        yield sides


def _cell(num: int, den: int, steps):
    """Links between two blocks of classes that connect what was not connected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sides in _sides(batches):
            same = len(sides) == 1
            sides = [sides[0], sides[-1]]
            signatures = [np.frombuffer(b"".join(m["signature"] for m in side), np.uint32).reshape(-1, MINIMA)
                          for side in sides]
            keys = [band_keys(s) for s in signatures]
            sizes = [np.array([len(m["shingles"]) // 8 for m in side]) for side in sides]
            meet = np.zeros((len(sides[0]), len(sides[1])), dtype=bool)
            for k in range(BANDS):
                meet |= keys[0][:, k, None] == keys[1][None, :, k]
            small, large = np.minimum.outer(*sizes), np.maximum.outer(*sizes)
            meet &= den * small >= num * large
            i, j = np.nonzero(np.triu(meet, 1) if same else meet)
            alive = probable(signatures[0][i], signatures[1][j], steps)
            known = Forest()
            found = []
            for a, b in zip(i[alive].tolist(), j[alive].tolist()):
                left, right = sides[0][a], sides[1][b]
                if known.apart(left["label"], right["label"]) and linked(
                        np.frombuffer(left["shingles"], _U), np.frombuffer(right["shingles"], _U), num, den):
                    known.join(left["label"], right["label"])
                    found.append((left["digest"], right["digest"]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["u", "v"])
    return run


def _against(some: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """Stored pairs (u, v) with both sides' ``value`` as left and right.

    A few v may stand in many pairs: one of more than a ``PARTS``-th of all
    pairs gets as many rows on the right, each of which meets a part of them.
    """
    total = some.count()                         # from the files' footers
    many = some.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * PARTS > F.lit(total)).collect()   # below PARTS
    cuts = F.broadcast(some.sparkSession.createDataFrame([(r.v, -(-r.n * PARTS // total)) for r in many], "v long, cuts int"))
    n = F.coalesce("cuts", F.lit(1))
    left = some.join(table.select(F.col("digest").alias("u"), F.col(value).alias("left")), "u") \
        .join(cuts, "v", "left").withColumn("part", F.pmod(F.xxhash64("u"), n).cast("int")).drop("cuts")
    right = table.select(F.col("digest").alias("v"), F.col(value).alias("right")) \
        .join(cuts, "v", "left").withColumn("part", F.explode(F.sequence(F.lit(0), n - 1))).drop("cuts")
    return left.join(right, ["v", "part"]).drop("part")


def _hub_pairs(shared: DataFrame, classes: DataFrame, steps) -> DataFrame:
    """Classes and hubs of their keys that may link."""
    pairs = write_scratch(shared.filter("digest <> hub").select(F.col("digest").alias("u"), F.col("hub").alias("v")).distinct(),
                          "hub-pairs")
    return write_scratch(_against(pairs, classes, "signature").mapInArrow(_pairs_probable(steps), "u long, v long"), "probable")


def _rest_links(entries: DataFrame, labels: DataFrame, sets: DataFrame, num: int, den: int, steps) -> DataFrame:
    """Links within keys that still hold several labels; ``entries`` are those of keys of 3 classes or more."""
    labelled = write_scratch(entries.join(labels, "digest", "left").select(
        "key", "digest", "hub", F.coalesce("root", "digest").alias("label")), "labelled")
    apart = write_scratch(labelled.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"))
        .filter("low <> high").select("key", "n"), "apart")
    open_entries = write_scratch(join_skewed(labelled, apart.select("key"), "key", apart), "open")
    # Classes that meet in many keys have a smallest hub in common: it only decides who shares a block.
    members = open_entries.groupBy("digest").agg(F.min("hub").alias("family"), F.min("label").alias("label")) \
        .join(sets.select("digest", (F.octet_length("shingles") / 8).alias("size")), "digest")
    # A label that fills a block of its own family has blocks of its own, the others share theirs.
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_SHINGLES)).alias("blocks")
    whole = members.groupBy("family", "label").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") >= BLOCK).select("family", "label", F.lit(True).alias("large"))
    grouped = members.join(whole, ["family", "label"], "left").withColumn("own", F.when(F.col("large"), F.col("label")))
    counts = grouped.groupBy("family", "own").agg(blocks).select(
        F.col("family").alias("f"), F.col("own").alias("o"), "blocks")
    placed = write_scratch(grouped.join(counts, (F.col("family") == F.col("f")) & F.col("own").eqNullSafe(F.col("o"))).select(
        "digest", "label", "own", F.xxhash64("family", F.coalesce("own", F.lit(0)), F.col("own").isNull(),
                                             F.pmod(F.xxhash64("digest"), "blocks")).alias("block")), "blocks")
    held = write_scratch(open_entries.select("key", "digest").join(placed.select("digest", "block", "own"), "digest")
                         .select("key", "block", "own").distinct(), "blocks-of-keys")
    pairs = block_pairs(held, "own").filter("left_own is null or right_own is null or left_own <> right_own") \
        .select("left_block", "right_block").distinct().unionByName(placed.filter("own is null").select(
            F.col("block").alias("left_block"), F.col("block").alias("right_block")).distinct())
    cells = pairs.select(F.explode(F.array_distinct(F.array("left_block", "right_block"))).alias("block"),
                         F.struct("left_block", "right_block").alias("cell"))
    # Each block is put together once, where the list of its cells is, and goes from there to all of them.
    members = placed.join(sets, "digest").groupBy("block").agg(
        F.collect_list(F.struct("digest", "label", "signature", "shingles")).alias("members"))
    dealt = members.join(cells.groupBy("block").agg(F.collect_list("cell").alias("cells")).hint("shuffle_merge"), "block") \
        .select(F.inline("cells"), "block", "members")
    met = dealt.repartition("left_block", "right_block").sortWithinPartitions("left_block", "right_block", "block")
    return write_scratch(met.select("left_block", "right_block", "members").mapInArrow(_cell(num, den, steps), "u long, v long"),
                         "rest-links")


def minhash_dedup(docs: DataFrame, width: int = 3, num: int = 85, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set is
    its distinct runs of ``width`` words (all words as one, if fewer).  Two
    documents link if the sets' Jaccard similarity reaches ``num / den``;
    ``component_id`` is the smallest doc_id reachable by links, and ``kept``
    tells whether it is the document's own.  Every link is confirmed on the
    full sets; a pair of similarity num / den is overlooked with a probability
    of about 2e-8 by the bands (at 0.85) and ``MISS`` by the posterior.

    Null and empty texts, and texts of white space alone, have 0 shingles, no
    links and their own id.  Repeated rows link with each other, each gives a
    row, and all rows of the smallest id are kept.  A null doc_id is never a
    component_id while another id is reachable; alone, it is its own
    component and kept.  Other columns are ignored; an empty table gives no
    rows.  Texts and groups may be of any size: sets are held one block of
    about ``BLOCK`` classes and ``BLOCK_SHINGLES`` shingles at a time.
    """
    ship_package(docs.sparkSession)
    steps = least_matches(num / den)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = write_scratch(map_slices(
        texts, _scan(width), "doc_id long, n_shingles long, digest long, signature binary", limit=SLICE), "rows")
    classes = write_scratch(rows.filter("signature is not null").select("digest", "signature")
                            .dropDuplicates(["digest"]), "classes")
    entries = classes.select("digest", "signature").mapInArrow(_entries, "key long, digest long")
    hubs = write_scratch(entries.groupBy("key").agg(F.min("digest").alias("hub"), F.count(F.lit(1)).alias("n"))
                         .filter("n > 1"), "hubs")
    shared = write_scratch(join_skewed(entries, hubs.select("key", "hub", (F.col("n") > 2).alias("several")), "key", hubs),
                           "shared")
    probable = _hub_pairs(shared, classes, steps)
    # Classes whose sets may be counted: those of probable pairs, and those that meet others than the hub.
    counted = write_scratch(probable.select(F.explode(F.array("u", "v")).alias("digest"))
                            .unionByName(shared.filter("several").select("digest")).distinct(), "counted")
    sets = write_scratch(map_slices(texts, _sets(width, Filter(counted, "digest")), "digest long, signature binary, shingles binary", limit=SLICE)
                         .join(counted, "digest").dropDuplicates(["digest"]), "sets")
    links = write_scratch(_against(probable, sets, "shingles").mapInArrow(_pairs_linked(num, den), "u long, v long"), "hub-links")
    labels = links.groupBy(F.col("u").alias("digest")).agg(F.min("v").alias("root"))
    rest = _rest_links(shared.filter("several").select("key", "digest", "hub"), labels, sets, num, den, steps)
    reached = components(links.unionByName(rest))

    mine = rows.select("doc_id", "n_shingles", "digest")
    held = mine.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
    held = write_scratch(held.join(reached.select(F.col("node").alias("digest"), "root"), "digest", "left")
                         .withColumn("root", F.coalesce("root", "digest")), "held")
    roots = write_scratch(held.groupBy("root").agg(F.min("low").alias("component"), F.count(F.lit(1)).alias("n")), "roots")
    named = write_scratch(join_skewed(held, roots.select("root", "component"), "root", roots)
                          .select("digest", "component", "n"), "named")
    joined = join_skewed(mine.filter("digest is not null"), named.select("digest", "component"), "digest", named).unionByName(
        mine.filter("digest is null").withColumn("component", F.lit(None).cast("long")))
    component = F.coalesce("component", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))
