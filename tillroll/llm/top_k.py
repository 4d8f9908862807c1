"""Exact top-k inner-product search: a ball tree per shard, branch and bound.

Vectors are dealt to shards by a hash of their id; each shard becomes ball
trees of a bounded number of vectors.  The queries, in blocks, meet every
tree.  A node's bound on the inner product is q.centre + |q| * radius; a query
goes into the child with the larger bound first and leaves out nodes that
cannot reach its current k-th score.  That score starts from a first tree,
searched before all others; a task then carries it on from tree to tree of its
shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.frames import pack, shuffle_partitions, unpack, write_scratch

TREE_ROWS = 8192
LEAF_ROWS = 128
BLOCK_ROWS = 1024
BLOCKS_HELD = 256                # blocks whose best hits a searching task keeps at a time
EXACT = 2.0 ** 53                # sums of whole doubles below this are exact
NONE = np.iinfo(np.int64).min    # score of no candidate
MOST = np.iinfo(np.int64).max


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of rows with an id and finite components; floor(256 * x) of each component.

    From 2^53 on a double is whole already.  A component whose 256-fold is no
    finite double any more counts as non-finite: its vector takes no part.
    """
    scaled = lambda x: F.lit(256.0) * x.cast("double")
    whole = lambda y: F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y)
    vector = F.transform(F.col(vector_col), lambda x: whole(scaled(x)))
    good = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scaled(x)) < float("inf")))
    return rows.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & good) \
        .select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, matrix) of the vectors of a batch, by dimension."""
    vectors = batch.column("vector")
    sizes = np.diff(np.asarray(vectors.offsets))
    flat = vectors.flatten().to_numpy()
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield int(dim), at, flat[starts[at][:, None] + np.arange(dim)[None, :]]


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole doubles as int64, exact; those beyond int64 stop at its ends."""
    with np.errstate(all="ignore"):
        limit = np.abs(a).sum(axis=1).max(initial=0) * np.abs(b).max(initial=0)
        if limit < EXACT:
            return (a @ b.T).astype(np.int64)
    out = np.empty((len(a), len(b)), np.int64)
    right = [[int(x) for x in row] for row in b]
    for i, row in enumerate(a):
        left = [int(x) for x in row]
        for j, other in enumerate(right):
            out[i, j] = max(NONE + 1, min(MOST, sum(x * y for x, y in zip(left, other))))
    return out


def _nearest_first(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores of each row with their ids, ties to the smaller id."""
    best = np.lexsort((ids, -scores.astype(np.float64)), axis=1) if np.abs(scores[scores > NONE]).max(initial=0) < EXACT else \
        np.array([sorted(range(ids.shape[1]), key=lambda c: (-int(s[c]), int(i[c]))) for i, s in zip(ids, scores)])
    best = best[:, :k]
    return np.take_along_axis(ids, best, axis=1), np.take_along_axis(scores, best, axis=1)


class BallTree:
    """Vectors in tree order, and nodes (low, high, left, right) with centres and radii."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.arange(len(ids))
        nodes, centres, radii = [], [], []

        def build(low: int, high: int) -> int:
            part = rows[order[low:high]]
            centre = part.mean(axis=0)
            me = len(nodes)
            nodes.append([low, high, -1, -1])
            centres.append(centre)
            radii.append(np.sqrt(((part - centre) ** 2).sum(axis=1).max()))
            if high - low > LEAF_ROWS and radii[me] > 0:
                far = part[((part - centre) ** 2).sum(axis=1).argmax()]
                other = part[((part - far) ** 2).sum(axis=1).argmax()]
                along = part @ (other - far)
                by = np.argsort(along, kind="stable")
                order[low:high] = order[low:high][by]
                middle = (low + high) // 2
                nodes[me][2] = build(low, middle)
                nodes[me][3] = build(middle, high)
            return me
        build(0, len(ids))
        self.ids, self.rows = ids[order], rows[order]
        self.nodes, self.centres, self.radii = np.array(nodes), np.array(centres), np.array(radii)

    def packed(self) -> bytes:
        return pack(self.ids, self.rows.reshape(-1), self.nodes.reshape(-1), self.centres.reshape(-1), self.radii)

    @classmethod
    def unpacked(cls, value: bytes) -> BallTree:
        tree = cls.__new__(cls)
        tree.ids, rows, nodes, centres, tree.radii = unpack(value)
        dim = len(rows) // len(tree.ids)
        tree.rows, tree.nodes, tree.centres = rows.reshape(-1, dim), nodes.reshape(-1, 4), centres.reshape(-1, dim)
        return tree

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray):
        """Ids and scores (queries x k, best first; score NONE where none); floors: scores that count as reached."""
        n = len(queries)
        ids = np.full((n, k), MOST)
        scores = np.full((n, k), NONE)
        with np.errstate(all="ignore"):
            norms = np.sqrt((queries * queries).sum(axis=1))
            # The bound is a little high, so that rounding never leaves out a tie.
            centres = queries @ self.centres.T
            spread = norms[:, None] * (self.radii + 1e-9 * np.sqrt((self.centres ** 2).sum(axis=1)))[None, :]
            bounds = centres + spread + 1e-9 * (np.abs(centres) + spread) + 1e-6
        bounds[~np.isfinite(bounds)] = np.inf              # components too large for squares: nothing is left out

        def visit(node: int, who: np.ndarray) -> None:
            who = who[bounds[who, node] >= np.maximum(scores[who, -1], floors[who])]
            if not len(who):
                return
            low, high, left, right = self.nodes[node]
            if left < 0:
                found = inner_products(queries[who], self.rows[low:high])
                mine = self.ids[low:high]
                found[own[who][:, None] == mine[None, :]] = NONE
                ids[who], scores[who] = _nearest_first(
                    np.concatenate([ids[who], np.broadcast_to(mine, found.shape)], axis=1),
                    np.concatenate([scores[who], found], axis=1), k)
                return
            first = bounds[who, left] >= bounds[who, right]
            for group, a, b in ((who[first], left, right), (who[~first], right, left)):
                if len(group):
                    visit(a, group)
                    visit(b, group)
        visit(0, np.arange(n))
        return ids, scores


def _deal(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            shard = batch.column("shard").to_numpy()
            out = []
            for dim, at, rows in _matrices(batch):
                for s in np.unique(shard[at]):
                    some = np.flatnonzero(shard[at] == s)
                    out.append((int(s), dim, pack(ids[at[some]], rows[some].reshape(-1))))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()),
                                              pa.array([o[1] for o in out], pa.int32()),
                                              pa.array([o[2] for o in out], pa.binary())], ["shard", "dim", "payload"])
    return run


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(shard, number, dimension, ids, rows) of at most ``limit`` rows each."""
    held: dict[int, list] = {}
    shard, number = 0, 0

    def cut(dim: int, least: int):
        nonlocal number
        ids = np.concatenate([i for i, _ in held[dim]])
        rows = np.concatenate([r for _, r in held[dim]])
        while len(ids) and len(ids) >= least:
            yield shard, number, dim, ids[:limit], rows[:limit]
            number += 1
            ids, rows = ids[limit:], rows[limit:]
        held[dim] = [(ids, rows)]
    for batch in batches:
        for s, dim, payload in zip(batch.column("shard").to_pylist(), batch.column("dim").to_pylist(),
                                   batch.column("payload")):
            shard = s
            ids, rows = unpack(payload.as_py())
            held.setdefault(dim, []).append((ids, rows.reshape(-1, dim)))
            if sum(len(i) for i, _ in held[dim]) >= limit:
                yield from cut(dim, limit)
    for dim in list(held):
        yield from cut(dim, 1)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, number, dim, ids, rows in _gathered(batches, TREE_ROWS):
        order = np.argsort(ids, kind="stable")
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([(number << 32) + shard], pa.int64()), pa.array([dim], pa.int32()),
             pa.array([BallTree(ids[order], rows[order]).packed()], pa.binary())], ["shard", "tree", "dim", "payload"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, number, dim, ids, rows in _gathered(batches, BLOCK_ROWS):
        yield pa.RecordBatch.from_arrays(
            [pa.array([(number << 32) + shard], pa.int64()), pa.array([dim], pa.int32()),
             pa.array([pack(ids, rows.reshape(-1))], pa.binary())], ["block", "dim", "queries"])


_HITS = "query_id long, vec_id long, score long"


def _hits(own, ids, scores) -> pa.RecordBatch:
    have = scores > NONE
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(own, have.sum(axis=1))), pa.array(ids[have]), pa.array(scores[have])],
        ["query_id", "vec_id", "score"])


def _first(k: int):
    """Search of the first tree: the block goes on with each query's k-th score, and its hits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                own, rows = unpack(batch.column("queries")[i].as_py())
                tree = BallTree.unpacked(batch.column("payload")[i].as_py())
                ids, scores = tree.search(own, rows.reshape(-1, dim), k, np.full(len(own), NONE))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(i, 1), pa.array([dim], pa.int32()),
                     pa.array([pack(own, rows, np.ascontiguousarray(scores[:, -1]))], pa.binary()),
                     pa.array([pack(ids.reshape(-1), scores.reshape(-1))], pa.binary()),
                     batch.column("tree").slice(i, 1)], ["block", "dim", "queries", "hits", "first"])
    return run


def _first_hits(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for queries, hits in zip(batch.column("queries"), batch.column("hits")):
                own = unpack(queries.as_py())[0]
                ids, scores = unpack(hits.as_py())
                yield _hits(own, ids.reshape(-1, k), scores.reshape(-1, k))
    return run


def _rest(k: int):
    """Search of all other trees: what a block's queries have reached in one tree is the floor in the next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}              # block -> ids of the queries, first floors, best ids and scores so far

        def given(block: int) -> pa.RecordBatch:
            own, floors, ids, scores = held.pop(block)
            scores[scores < floors[:, None]] = NONE
            return _hits(own, ids, scores)
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("block")[i].as_py()
                own, rows, floors = unpack(batch.column("queries")[i].as_py())
                if block in held:
                    _, _, ids, scores = held.pop(block)
                else:
                    ids, scores = np.full((len(own), k), MOST), np.full((len(own), k), NONE)
                tree = BallTree.unpacked(batch.column("payload")[i].as_py())
                more = tree.search(own, rows.reshape(len(own), -1), k, np.maximum(floors, scores[:, -1]))
                held[block] = (own, floors, *_nearest_first(
                    np.concatenate([ids, more[0]], axis=1), np.concatenate([scores, more[1]], axis=1), k))
                if len(held) > BLOCKS_HELD:      # the block that was searched longest ago
                    yield given(next(iter(held)))
        for block in list(held):
            yield given(block)
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products of each query, exact.

    ``vectors`` and ``queries`` have vec_id and a vector of finite whole
    numbers (as doubles, of any size).  Scores are exact integers; one beyond
    the range of a long counts as the end of that range.  Ties go to the smaller vec_id; candidates with the query's own
    id are left out; vectors of another dimension are no candidates.  A
    query id that occurs several times is searched once, with its smallest
    vector; repeated candidate rows each count.  Empty input gives no rows.
    """
    spark = vectors.sparkSession
    shards = shuffle_partitions(spark)
    dealt = "shard int, dim int, payload binary"
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    trees = write_scratch(
        vectors.select("vec_id", "vector", shard).mapInArrow(_deal(shards), dealt)
        .repartitionById(shards, F.col("shard")).mapInArrow(_trees, "shard int, tree long, dim int, payload binary"), "trees")
    blocks = queries.groupBy("vec_id").agg(F.min("vector").alias("vector")) \
        .select("vec_id", "vector", F.lit(0).alias("shard")).mapInArrow(_deal(1), dealt) \
        .select(F.pmod(F.xxhash64("payload"), F.lit(shards)).cast("int").alias("shard"), "dim", "payload") \
        .repartitionById(shards, F.col("shard")).mapInArrow(_blocks, "block long, dim int, queries binary")
    heads = trees.groupBy("dim").agg(F.min_by(F.struct("tree", "payload"), "tree").alias("head")) \
        .select("dim", "head.tree", "head.payload")
    begun = write_scratch(blocks.join(heads, "dim").mapInArrow(
        _first(k), "block long, dim int, queries binary, hits binary, first long"), "blocks")
    # Each block goes to every shard: the trees of a shard and all blocks meet by (shard, dim).
    everywhere = begun.select("dim", "block", "queries", "first", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    found = trees.join(everywhere, ["shard", "dim"]).filter("tree <> first") \
        .select("payload", "block", "queries").mapInArrow(_rest(k), _HITS)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return begun.mapInArrow(_first_hits(k), _HITS).unionByName(found) \
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
