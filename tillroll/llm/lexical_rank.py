"""Ranked lexical search of many items at once, over shared partial sums.

Items of one benchmark share many terms.  What they share is mined first and
added up once per document:

1. terms that the same items use equally often are one *atom*;
2. pairs of parts that two or more items hold become a part of their own,
   round after round: a DAG whose inner nodes are term sets shared by items;
3. a pass over the documents keeps the hits (document, term, tf) and counts
   df, the number of documents and their terms;
4. a pass over the hits fills one accumulator per atom and document, then
   one per DAG node from its two parts, then each item's score from the few
   parts that are left of it.

Items are taken in blocks of about ``ITEM_BYTES`` of text, so that a block's
DAG and weights are small enough for every task; a further block is a further
pass over the documents.  A task keeps its best k documents of each item.
Scores are exact integers, so the order of the sums does not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.frames import pack, ship_package, slices, unpack, write_scratch
from tillroll.llm.words import split_words

ITEM_BYTES = 1 << 20             # text of items handled in one pass, about
NEAR = 8                         # parts of an item that are tried as partners of a part
MATRIX_BYTES = 32 << 20          # accumulators held at once by a task
KEPT = 1 << 16                   # candidates that a task collects before it cuts them to the best
SATURATION, LENGTH = 8, 75       # fixed by the scoring rule: 8 / 1000 and 75 %

# Terms are runs of ASCII letters and digits and of everything beyond ASCII.
IS_TERM = np.zeros(256, dtype=bool)
IS_TERM[48:58] = IS_TERM[65:91] = IS_TERM[97:123] = IS_TERM[128:] = True


@dataclass
class Sharing:
    """What a block of items adds up: terms to atoms, pairs to nodes, nodes to items."""

    terms: np.ndarray            # sorted hashes
    atom: np.ndarray             # of each term
    atoms: int
    pairs: np.ndarray            # (left, times, right, times) of nodes atoms, atoms + 1, ...
    level: np.ndarray            # of each pair; a pair uses lower levels only
    first: np.ndarray            # n + 1 offsets of the items' parts
    part: np.ndarray
    times: np.ndarray
    ids: np.ndarray
    valid: np.ndarray

    def packed(self) -> bytes:
        return pack(self.terms, self.atom, np.array([self.atoms]), self.pairs.reshape(-1), self.level, self.first,
                    self.part, self.times, self.ids, self.valid)

    @classmethod
    def unpacked(cls, value: bytes) -> Sharing:
        terms, atom, atoms, pairs, *rest = unpack(value)
        return cls(terms, atom, int(atoms[0]), pairs.reshape(-1, 4), *rest)


def _atoms(item: np.ndarray, term: np.ndarray, times: np.ndarray, n: int) -> np.ndarray:
    """The atom of each of ``n`` terms: equal for terms that the same items use equally often."""
    order = np.lexsort((item, term))
    use = np.stack([item, times], axis=1)[order]
    first = np.searchsorted(term[order], np.arange(n + 1))
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(use[a:b].tobytes(), len(seen)) for a, b in zip(first[:-1], first[1:])], np.int64)


def _shared_pairs(item: np.ndarray, symbol: np.ndarray, n: int) -> np.ndarray:
    """For each symbol the number of the pair it is merged in, or -1; no symbol is in two pairs."""
    uses = np.bincount(symbol, minlength=n)
    many = uses[symbol] > 1
    item, symbol = item[many], symbol[many]
    order = np.lexsort((symbol, -uses[symbol], item))          # common parts stand next to each other
    item, symbol = item[order], symbol[order]
    codes = []
    for step in range(1, NEAR + 1):
        a, b = symbol[:-step], symbol[step:]
        inside = item[:-step] == item[step:]
        codes.append((np.minimum(a, b) * n + np.maximum(a, b))[inside])
    codes, counts = np.unique(np.concatenate(codes) if codes else np.zeros(0, np.int64), return_counts=True)
    pair, found = np.full(n, -1), 0
    for at in np.argsort(-counts, kind="stable"):
        if counts[at] < 2:
            break
        a, b = divmod(int(codes[at]), n)
        if pair[a] < 0 and pair[b] < 0:
            pair[a] = pair[b] = found
            found += 1
    return pair


def share(item: np.ndarray, term: np.ndarray, n_items: int, ids: np.ndarray, valid: np.ndarray) -> Sharing:
    """Mine what items share; ``item`` and ``term`` (hash) hold one entry per occurrence of a term."""
    terms, which = np.unique(term, return_inverse=True)
    uses, times = np.unique(item * max(len(terms), 1) + which, return_counts=True)
    item, which = np.divmod(uses, max(len(terms), 1))
    atom = _atoms(item, which, times, len(terms))
    atoms = int(atom.max()) + 1 if len(atom) else 0
    once, at = np.unique(item * max(atoms, 1) + atom[which], return_index=True)
    item, node = np.divmod(once, max(atoms, 1))
    times = times[at].astype(np.int64)
    pairs, levels, depth = [], [], np.zeros(atoms, np.int64)
    while len(item):
        most = int(times.max()) + 1
        symbols, symbol = np.unique(node * most + times, return_inverse=True)
        pair = _shared_pairs(item, symbol, len(symbols))
        if pair.max() < 0:
            break
        mine = pair[symbol]
        key = np.where(mine >= 0, item * len(symbols) + mine, -1)
        keys, where, counts = np.unique(key, return_inverse=True, return_counts=True)
        merged = (counts[where] == 2) & (key >= 0)
        left, right = (np.full(pair.max() + 1, -1) for _ in range(2))
        have = np.flatnonzero(pair >= 0)
        left[pair[have[::-1]]] = have[::-1]                     # the lower symbol of each pair
        right[pair[have]] = have
        base = atoms + len(pairs)
        for a, b in zip(left.tolist(), right.tolist()):
            (na, ta), (nb, tb) = divmod(int(symbols[a]), most), divmod(int(symbols[b]), most)
            pairs.append((na, ta, nb, tb))
            levels.append(max(depth[na], depth[nb]) + 1)
        depth = np.concatenate([depth, levels[base - atoms:]])
        new = np.unique(key[merged])
        item = np.concatenate([item[~merged], new // len(symbols)])
        node = np.concatenate([node[~merged], base + new % len(symbols)])
        times = np.concatenate([times[~merged], np.ones(len(new), np.int64)])
    order = np.argsort(item, kind="stable")
    first = np.searchsorted(item[order], np.arange(n_items + 1))
    return Sharing(terms, atom, atoms, np.array(pairs, np.int64).reshape(-1, 4), np.array(levels, np.int64),
                   first.astype(np.int64), node[order], times[order], ids, valid)


def _mine(table: pa.Table) -> pa.Table:
    words = split_words(table.column("text"), IS_TERM)
    ids = table.column("item_id").combine_chunks()
    item = np.repeat(np.arange(table.num_rows), words.counts)
    plan = share(item, words.hashes(), table.num_rows,
                 ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                 np.asarray(ids.is_valid()).astype(np.uint8))
    return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()),
                     "sharing": pa.array([plan.packed()], pa.binary())})


def _hits(terms: np.ndarray):
    """Documents' hits, one packed row a slice; then the task's df counts, and its documents and terms as -1 and -2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(terms), np.int64)
        n_docs = n_terms = 0
        for piece in slices(batches):
            words = split_words(piece.column("text"), IS_TERM)
            ids = piece.column("doc_id")
            hashes = words.hashes()
            at = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
            hit = np.flatnonzero(terms[at] == hashes) if len(terms) else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(piece.num_rows), words.counts)[hit]
            found, tf = np.unique(doc * max(len(terms), 1) + at[hit], return_counts=True)
            doc, term = np.divmod(found, max(len(terms), 1))
            counts += np.bincount(term, minlength=len(terms))
            n_docs += int((words.counts > 0).sum())
            n_terms += len(hashes)
            some, place = np.unique(doc, return_inverse=True)
            if len(some):
                yield _rows([None], [None], [pack(
                    ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[some],
                    np.asarray(ids.is_valid()).astype(np.uint8)[some], words.counts[some].astype(np.int64),
                    place.astype(np.int32), term.astype(np.int32), tf.astype(np.int32))])
        seen = np.flatnonzero(counts)
        yield _rows([*seen.tolist(), -1, -2], [*counts[seen].tolist(), n_docs, n_terms], [None] * (len(seen) + 2))
    return run


def _rows(term, n, payload) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(n, pa.int64()),
                                       pa.array(payload, pa.binary())], ["term", "n", "payload"])


def _best(item, score, doc, valid, k):
    """Indices of each item's k best entries; equal scores by id, null ids last."""
    order = np.lexsort((doc, 1 - valid, -score, item))
    first = np.searchsorted(item[order], item[order], side="left")
    return order[np.arange(len(order)) - first < k]


def _scores(plan: Sharing, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    nodes = plan.atoms + len(plan.pairs)
    width = max(8, MATRIX_BYTES // (8 * max(nodes + len(plan.part), 1)))
    steps = [np.flatnonzero(plan.level == d) for d in range(1, int(plan.level.max(initial=0)) + 1)]
    used = np.flatnonzero(np.diff(plan.first))

    def accumulate(doc, term, value, n):
        acc = np.zeros((nodes, n), np.int64)
        np.add.at(acc, (plan.atom[term], doc), value)
        for some in steps:
            a, ta, b, tb = plan.pairs[some].T
            acc[plan.atoms + some] = acc[a] * ta[:, None] + acc[b] * tb[:, None]
        return np.add.reduceat(acc[plan.part] * plan.times[:, None], plan.first[used], axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.ones(len(used), np.int64)                    # score that an item's next document must reach
        kept = [np.zeros(0, np.int64) for _ in range(4)]

        def cut(parts):
            item, score, doc, valid = (np.concatenate(x) for x in zip(*parts))
            best = _best(item, score, doc, valid, k)
            item, score, doc, valid = item[best], score[best], doc[best], valid[best]
            full = np.flatnonzero(np.bincount(item, minlength=len(used)) == k)
            last = np.searchsorted(item, full, side="right") - 1
            least[full] = score[last]
            return [item, score, doc, valid]

        parts, waiting = [kept], 0
        for batch in batches:
            for payload in batch.column("payload"):
                ids, valid, n, doc, term, tf = unpack(payload.as_py())
                m = 100 - LENGTH + (LENGTH * n * n_docs) // n_terms
                tf = tf.astype(np.int64)
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + SATURATION * m[doc]))
                first = np.searchsorted(doc, np.arange(0, len(ids) + width, width))
                for low, a, b in zip(range(0, len(ids), width), first[:-1], first[1:]):
                    size = min(width, len(ids) - low)
                    score = accumulate(doc[a:b] - low, term[a:b], value[a:b], size)
                    i, j = np.nonzero(score >= least[:, None])
                    parts.append([i, score[i, j], ids[low + j], valid[low + j].astype(np.int64)])
                    waiting += len(i)
                    if waiting > KEPT:
                        parts, waiting = [cut(parts)], 0
        item, score, doc, valid = cut(parts)
        if len(item):
            row = used[item]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(plan.ids[row], mask=plan.valid[row] == 0), pa.array(doc, mask=valid == 0),
                 pa.array(score)], ["item", "item_id", "doc_id", "score"])
    return run


def _block(docs: DataFrame, plan: Sharing, k: int) -> DataFrame:
    """Each task's best documents of one block of items."""
    hits = write_scratch(docs.mapInArrow(_hits(plan.terms), "term long, n long, payload binary"), "hits")
    # At most one row per term of a block of items.
    counts = dict(hits.filter("term is not null").groupBy("term").agg(F.sum("n")).toArrow().to_pandas().itertuples(index=False))
    n_docs, n_terms = int(counts.get(-1, 0)), int(counts.get(-2, 0))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(counts.get(t, 0)) + 1)))
                        for t in range(len(plan.terms))], np.int64)
    return hits.filter("payload is not null").select("payload").mapInArrow(
        _scores(plan, weights, n_docs, n_terms, k), "item long, item_id long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (int from 1), doc_id, score of each item's ``k`` best documents.

    Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``
    with A-Z lower-cased.  With N documents that hold a term, L terms in all
    and n terms of a document, a term of df documents weighs
    ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and adds
    ``w * (10^9 tf div (1000 tf + 8m))``, ``m = 25 + (75nN) div L``, for every
    occurrence in the item.  Documents of score 0 are no result.

    Null and empty texts hold no term: such documents count nowhere, such
    items have no rows.  Every row of ``docs`` is a document and every row of
    ``items`` an item of its own, repeated rows and null ids included; equal
    scores go by ascending doc_id, null ids last.  Other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES) or 1
    mined = write_scratch(
        asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("long")).groupBy("block")
        .applyInArrow(_mine, "block long, sharing binary"), "sharing")
    found = None
    for block in sorted(r.block for r in mined.select("block").collect()):
        plan = Sharing.unpacked(mined.filter(F.col("block") == block).first().sharing)
        if not len(plan.terms):
            continue
        some = _block(texts, plan, k).withColumn("block", F.lit(block))
        found = some if found is None else found.unionByName(some)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # Every task may hold k rows of an item: they are cut in 64 parts first.
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    for keys in (["block", "item", "part"], ["block", "item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))) \
            .filter(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark),
q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
lens AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
tot AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM lens),
tf AS (SELECT doc_id, term, count(*) AS tf
       FROM (SELECT doc_id, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM tf, tot GROUP BY term, nd),
s AS (
  SELECT q.item_id, tf.doc_id,
         CAST(sum(q.qtf * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * l.n * tot.nd) // tot.nt)))) AS BIGINT)
           AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN lens l ON l.doc_id = tf.doc_id, tot
  GROUP BY q.item_id, tf.doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
