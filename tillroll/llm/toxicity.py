"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words without ASCII punctuation and the first 4 and 6 bytes of
longer words, so that inflected and compounded forms meet.  The examples are a
bounded, seeded sample of the labelled rows, and every term of theirs is
indexed.  Weights are log(1 + count) times an inverse document frequency
counted over all documents; a text's norm takes in all its terms, also those
that no example has (their frequencies lie in the shared folder).

Terms of few examples have short postings, which are added up whole.  For the
terms of most examples the index keeps dense blocks of examples and the
largest weight of each term in each block.  A text first visits the block of
its largest bound, and then those alone whose bound can still reach its k-th
neighbour.  The k nearest vote by their distance, weighted back to the label
shares of all labelled rows; among them the distance over terms that tell the
labels apart counts, whatever else a text is about.

Votes become scores by a monotone map: every example is scored by the others,
and isotonic regression of the labels on these votes, weighted like them,
gives the share of toxic rows at each vote.  Index and map are made in a task
and stored in the shared folder, array by array; the scoring tasks map those
files into memory, so the workers of a machine hold them once, in its file cache.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import (
    delta, map_slices, memory_returned, pack, shuffle_partitions, signed, slices, undelta, unpack, write_scratch,
)
from tillroll.llm.lm_score import PACKED, TALLY, WORDS, _batch, _shards, _smallest, _store, _sum_by, arrays
from tillroll.llm.words import Words, mix, split_words
from tillroll.session import scratch_path

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
STEMS = (4, 6)
EXAMPLE_BLOCK = 64
COMMON = 512                     # terms with dense weights
TEXTS_AT_ONCE = 128
POSTINGS_AT_ONCE = 1 << 18
TERMS_AT_ONCE = 1_000_000
SLICE = 2 << 20                  # bytes of text handled at once


@dataclass(frozen=True)
class Neighbours:
    """Parameters of the classifier; the sample's bound is ``per_class`` rows of each label."""

    per_class: int = 2000
    min_examples: int = 5        # examples that a telling term is in, at least
    min_chi2: float = 40.0
    min_ratio: float = 6.0       # between the term's shares of the two classes, either way
    k: int = 200
    evidence: int = 15           # nearest examples that are given with a score
    smoothing: float = 0.5       # weight of the label shares among the votes
    reject_at: float = 0.5


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts of a column and the text of each, in no given order."""
    words = split_words(column, _TERM)
    owner = np.repeat(np.arange(len(words.first) - 1), words.counts)
    hashes, owners = [words.hashes()], [owner]
    for width in STEMS:
        long = np.flatnonzero(words.ends - words.starts > width)
        stem = Words(words.data, words.starts[long], words.starts[long] + width, words.first)
        hashes.append(mix(stem.hashes() + np.uint64(width)))
        owners.append(owner[long])
    return np.concatenate(hashes), np.concatenate(owners)


def _counted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct terms, and the distinct (text, position of its term) with counts, by text."""
    distinct, which = np.unique(hashes, return_inverse=True)
    bits = max(1, int(len(distinct)).bit_length())
    key = np.sort(owner.astype(np.int64) << bits | which)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
    counts = np.diff(np.append(first, len(key)))
    return distinct, key[first] >> bits, key[first] & (1 << bits) - 1, counts


@dataclass
class Rows:
    """Unit TF-IDF rows of texts: entries (vocabulary position, weight), text by text."""

    first: np.ndarray            # n + 1 offsets of the texts' entries
    at: np.ndarray
    weight: np.ndarray
    size: int                    # of the vocabulary

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def part(self, low: int, high: int) -> Rows:
        cut = slice(self.first[low], self.first[high])
        return Rows(self.first[low:high + 1] - self.first[low], self.at[cut], self.weight[cut], self.size)

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self), self.size))
        out[self.owner, self.at] = self.weight
        return out

    @property
    def T(self) -> np.ndarray:
        return self.dense().T

    def __matmul__(self, other: np.ndarray) -> np.ndarray:
        return self.dense() @ other


@dataclass
class Model:
    rule: Neighbours
    vocabulary: np.ndarray                 # sorted hashes of all terms of the examples
    folder: str                            # document frequencies of all terms
    shards: int
    n_docs: int
    ids: np.ndarray                        # examples, block by block
    toxic: np.ndarray
    vote: np.ndarray                       # weight of an example's label
    share: float                           # toxic share of all labelled rows
    empty_score: float                     # of texts without a neighbour
    telling: np.ndarray = field(default=None)       # whether a term's presence depends on the label
    column: np.ndarray = field(default=None)        # a term's row in ``dense``, -1 if it has postings
    dense: np.ndarray = field(default=None)         # common terms x examples
    most: np.ndarray = field(default=None)          # common terms x blocks, largest weight
    first: np.ndarray = field(default=None)         # offsets of each term's postings
    posting: np.ndarray = field(default=None)       # positions of examples
    weight: np.ndarray = field(default=None)
    marks: np.ndarray = field(default=None)         # telling terms x examples, unit columns
    blocks: list = field(default_factory=list)      # (start, end)
    scale: tuple = field(default=None)              # votes, ascending, and the scores they stand for

    def idf(self, df: np.ndarray) -> np.ndarray:
        return np.log((self.n_docs + 1) / (df + 1)) + 1

    def rows(self, column: pa.Array) -> Rows:
        """TF-IDF rows of texts over the vocabulary, each over the norm of all terms of its text."""
        n, size = len(column), len(self.vocabulary)
        if not size:
            return Rows(np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0), 0)
        distinct, t, which, c = _counted(*terms(column))
        df = arrays(self.folder).find("terms", distinct, self.shards, 1)[0]
        weight = np.log1p(c) * self.idf(df)[which]
        norm = np.sqrt(np.bincount(t, weight * weight, minlength=n))
        at = np.minimum(np.searchsorted(self.vocabulary, distinct), size - 1)
        have = (self.vocabulary[at] == distinct)[which]
        t = t[have]
        return Rows(np.searchsorted(t, np.arange(n + 1)), at[which[have]], weight[have] / norm[t], size)


# The arrays that tasks map from the shared folder.
MAPPED = ("vocabulary", "telling", "column", "dense", "most", "first", "posting", "weight", "marks")
_LOADED: dict[str, Model] = {}


def _store_model(model: Model) -> int:
    """Store a model in its folder, its large arrays as files of their own; the bytes of all."""
    large = {name: getattr(model, name) for name in MAPPED if getattr(model, name) is not None}
    for name, array in large.items():
        _store(model.folder, f"model-{name}", array)
    rest = np.frombuffer(pickle.dumps(replace(model, **dict.fromkeys(large)), protocol=5), np.uint8)
    _store(model.folder, "model", rest)
    return sum(array.nbytes for array in large.values()) + len(rest)


@dataclass(frozen=True)
class StoredModel:
    """A model in the shared folder: tasks load it, once per worker; the driver need not hold it."""

    rule: Neighbours
    folder: str

    def load(self) -> Model:
        if self.folder not in _LOADED:
            _LOADED.clear()
            files = arrays(self.folder)
            model = pickle.loads(files.get("model-0"))
            for name in MAPPED:
                mapped = files.get(f"model-{name}-0")
                setattr(model, name, None if mapped is None else np.asarray(mapped))
            _LOADED[self.folder] = model
        return _LOADED[self.folder]

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        return getattr(self.load(), name)


def index(model: Model, rows: Rows, ids: np.ndarray, toxic: np.ndarray, vote: np.ndarray) -> None:
    """Blocks of examples of alike weights (so their largest weights bound them well), and postings."""
    n, size = len(rows), rows.size
    least = np.full(n, np.inf)
    np.minimum.at(least, rows.owner, rows.weight)
    order = np.lexsort((ids, least))
    model.ids, model.toxic, model.vote = ids[order], toxic[order], vote[order]
    place = np.empty(n, np.int32)
    place[order] = np.arange(n)
    owner = place[rows.owner]
    model.blocks = [(low, min(low + EXAMPLE_BLOCK, n)) for low in range(0, n, EXAMPLE_BLOCK)]
    held = np.bincount(rows.at, minlength=size)
    common = np.sort(np.argsort(-held, kind="stable")[:COMMON])
    model.column = np.full(size, -1, np.int32)
    model.column[common] = np.arange(len(common))
    often = model.column[rows.at] >= 0
    model.dense = np.zeros((len(common), n))
    model.dense[model.column[rows.at[often]], owner[often]] = rows.weight[often]
    model.most = np.maximum.reduceat(model.dense, [low for low, _ in model.blocks], axis=1)
    at, who, weight = rows.at[~often], owner[~often], rows.weight[~often]
    by = np.lexsort((who, at))
    model.first = np.searchsorted(at[by], np.arange(size + 1))
    model.posting, model.weight = who[by], weight[by]
    del at, who, weight, by
    chosen = np.flatnonzero(model.telling)
    marked = model.telling[rows.at]
    model.marks = np.zeros((len(chosen), n))
    model.marks[np.searchsorted(chosen, rows.at[marked]), owner[marked]] = rows.weight[marked]
    model.marks = unit(model.marks.T).T


def _from_postings(model: Model, rows: Rows) -> np.ndarray:
    """Texts x examples: the part of each cosine that terms with postings give."""
    n, examples = len(rows), len(model.ids)
    out = np.zeros(n * examples)
    rare = np.flatnonzero(model.column[rows.at] < 0)
    low = model.first[rows.at[rare]]
    counts = model.first[rows.at[rare] + 1] - low
    base, weight, ends = rows.owner[rare] * examples, rows.weight[rare], np.cumsum(counts)
    if not len(rare):
        return out.reshape(n, examples)
    start = 0
    while start < len(rare):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + POSTINGS_AT_ONCE, side="right")))
        each = counts[start:end]
        spot = np.repeat(low[start:end] - (ends[start:end] - each - before), each)
        spot += np.arange(len(spot))
        # The texts of these entries, which come text by text: no other part of ``out`` changes.
        first, last = base[start], base[end - 1] + examples
        at = np.repeat(base[start:end] - first, each)
        at += model.posting[spot]
        gain = np.repeat(weight[start:end], each)
        gain *= model.weight[spot]
        out[first:last] += np.bincount(at, gain, last - first)
        start = end
    return out.reshape(n, examples)


def nearest(model: Model, rows: Rows, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest examples of each row: (similarities, positions; -1 if there are fewer).

    Only positive similarities count, ties go to the smaller id, and an
    example is no neighbour of its own document.  ``own``: ids of the rows.
    """
    k, n = model.rule.k, len(rows)
    sims, spots = np.zeros((n, k)), np.full((n, k), -1, np.int64)
    if not model.blocks:
        return sims, spots
    for low in range(0, n, TEXTS_AT_ONCE):
        high = min(low + TEXTS_AT_ONCE, n)
        found, who, spot = _visit(model, rows.part(low, high), own[low:high], k)
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        sims[low + who, rank], spots[low + who, rank] = found, spot
    return sims, spots


def _visit(model: Model, rows: Rows, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(similarity, row, example) of the k nearest of each row, nearest first."""
    n = len(rows)
    starts = np.array([b[0] for b in model.blocks])
    every = _from_postings(model, rows)
    column = model.column[rows.at]
    often = column >= 0
    dense = np.zeros((n, len(model.dense)))
    dense[rows.owner[often], column[often]] = rows.weight[often]
    bound = dense @ model.most + np.maximum.reduceat(every, starts, axis=1)
    sims = np.zeros(every.shape)
    by_id = np.argsort(model.ids)
    at = by_id[np.minimum(np.searchsorted(model.ids[by_id], own), len(by_id) - 1)]
    self_row = np.flatnonzero(model.ids[at] == own)
    self_spot = at[self_row]

    def visit(wanted: np.ndarray) -> None:
        for b, (low, high) in enumerate(model.blocks):
            who = np.flatnonzero(wanted[:, b])
            if len(who):
                sims[who, low:high] = np.round(every[who, low:high] + dense[who] @ model.dense[:, low:high], 9)
        sims[self_row, self_spot] = 0
    best = np.zeros(bound.shape, dtype=bool)
    best[np.arange(n), bound.argmax(axis=1)] = True
    visit(best)
    least = _kth(sims, k)
    visit((bound > 0) & (bound >= least[:, None] - 1e-9) & ~best)
    who, spot = np.nonzero((sims >= _kth(sims, k)[:, None]) & (sims > 0))
    found = sims[who, spot]
    order = np.lexsort((model.ids[spot], -found, who))
    who, spot, found = who[order], spot[order], found[order]
    keep = np.arange(len(who)) - np.searchsorted(who, who) < k
    return found[keep], who[keep], spot[keep]


def _kth(sims: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row (0 if there are fewer)."""
    return np.partition(sims, -k, axis=1)[:, -k] if sims.shape[1] >= k else np.zeros(len(sims))


def votes(model: Model, rows: Rows, sims: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Scores of texts from their neighbours' votes.

    A vote grows with the cosine, against the nearest's, and without bound for
    copies; its weight is the cosine of the telling terms of text and example
    (1 if neither has one).
    """
    have = spots >= 0
    if not len(model.ids) or not model.blocks:
        return np.full(len(sims), model.empty_score)
    top = np.where(have[:, :1], sims[:, :1], 1)
    near = (sims / top) ** 2 * (1.001 - np.minimum(top, 1)) / (1.001 - np.minimum(sims, 1))
    column = np.cumsum(model.telling) - 1
    told = model.telling[rows.at]
    text = np.zeros((len(rows), len(model.marks)))
    text[rows.owner[told], column[rows.at[told]]] = rows.weight[told]
    text = unit(text)
    alike = np.take_along_axis(text @ model.marks, spots, axis=1)
    neither = ~text.any(axis=1)[:, None] & ~model.marks.any(axis=0)[spots]
    weight = np.where(have, near * np.where(neither, 1, alike) * model.vote[spots], 0)
    extra = model.rule.smoothing
    score = ((weight * model.toxic[spots]).sum(axis=1) + extra * model.share) / (weight.sum(axis=1) + extra)
    return np.where(have.any(axis=1), score, model.empty_score)


def isotonic(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing step function of ``x`` that fits the labels best (pool adjacent violators)."""
    order = np.argsort(x, kind="stable")
    at, first = np.unique(x[order], return_index=True)
    pools = []                           # least and largest x, sum of labels, weight
    for v, s, w in zip(at, np.add.reduceat((label * weight)[order], first), np.add.reduceat(weight[order], first)):
        pools.append([v, v, s, w])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, high, s, w = pools.pop()
            pools[-1][1:] = [high, pools[-1][2] + s, pools[-1][3] + w]
    return np.array([p[k] for p in pools for k in (0, 1)]), np.array([p[2] / p[3] for p in pools for _ in (0, 1)])


def scores(model: Model, rows: Rows, sims: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Calibrated scores from neighbours' votes."""
    voted = votes(model, rows, sims, spots)
    return np.clip(voted if model.scale is None else np.interp(voted, *model.scale), 0, 1)


def calibrate(model: Model, rows: Rows, ids: np.ndarray, toxic: np.ndarray, vote: np.ndarray) -> None:
    """The scale from every example's vote without itself."""
    voted = []
    for low in range(0, len(rows), TEXTS_AT_ONCE):
        part = rows.part(low, min(low + TEXTS_AT_ONCE, len(rows)))
        voted.append(votes(model, part, *nearest(model, part, ids[low:low + TEXTS_AT_ONCE])))
    model.scale = isotonic(np.concatenate(voted), toxic, vote)


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def _example_terms(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    distinct, t, which, c = _counted(*terms(piece.column("text")))
    ids = piece.column("doc_id").to_numpy()
    yield pa.RecordBatch.from_arrays([pa.array(ids[t]), pa.array(signed(distinct[which])), pa.array(c.astype(np.int64))],
                                     ["doc_id", "term", "n"])


def learn(docs: DataFrame, labels: DataFrame, rule: Neighbours = Neighbours()) -> Model | StoredModel:
    """The model from ``labels`` (doc_id, label 0/1) and the texts of those documents.

    Labels other than 0 and 1 are left out; conflicting labels of one document
    count as 1.  Without labels, or with one label alone, no vocabulary results
    and all scores are the label share (0 without labels).
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    known = labels.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(shares.values())
    share = shares.get(1, 0) / total if total else 0.0
    sample = []
    for label in sorted(shares):
        sample += known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rule.per_class).collect()
    ids = np.array(sorted(r["doc_id"] for r in sample), np.int64)
    label_of = {r["doc_id"]: r["label"] for r in sample}
    toxic = np.array([label_of[i] for i in ids.tolist()], np.float64)
    vote = np.array([shares[int(x)] / min(shares[int(x)], rule.per_class) for x in toxic])
    model = Model(rule, np.zeros(0, np.uint64), "", 0, 0, np.zeros(0, np.int64), np.zeros(0), np.zeros(0), share, share)
    if len(shares) < 2:
        return model

    # At most 2 * per_class rows: the sample's ids are sent to the scan; its term counts stay in the shared folder.
    chosen = F.broadcast(spark.createDataFrame([(int(i),) for i in ids], "doc_id long"))
    entries = write_scratch(map_slices(texts.join(chosen, "doc_id"), _example_terms, "doc_id long, term long, n long", limit=SLICE)
                            .groupBy("doc_id", "term").agg(F.max("n").alias("n")), "example-terms")
    found = entries.select("term").distinct().toArrow()["term"].to_numpy()           # distinct terms of the sample
    model.vocabulary = np.sort(found.view(np.uint64))
    model.folder, model.shards, model.n_docs, df = _document_frequency(texts, model.vocabulary)
    # The sample's entries meet in one task: their number is bounded by the sample and its texts.
    entries.coalesce(1).mapInArrow(_build(model, ids, toxic, vote, df), "bytes long").collect()
    return StoredModel(rule, model.folder)


def _build(model: Model, ids: np.ndarray, toxic: np.ndarray, vote: np.ndarray, df: np.ndarray):
    """Make the model's index and scale from all entries (doc_id, term, n) of the examples, and store it in its folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for b in batches:                # a number for an entry, by example and term: each entry comes once
            who = np.searchsorted(ids, b.column("doc_id").to_numpy())
            keys.append(who << 32 | np.searchsorted(model.vocabulary, b.column("term").to_numpy().view(np.uint64)))
            counts.append(b.column("n").to_numpy().astype(np.int32))
        key, n = np.concatenate(keys), np.concatenate(counts)
        del keys, counts
        order = np.argsort(key)
        key, n = key[order], n[order]
        del order
        who, at = (key >> 32).astype(np.int32), key.astype(np.int32)
        del key
        weight = np.log1p(n, dtype=np.float64)
        weight *= model.idf(df)[at]
        norm = np.sqrt(np.bincount(who, weight * weight, minlength=len(ids)))
        weight /= norm[who]
        first = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(ids)))])
        rows = Rows(first, at, weight, len(model.vocabulary))
        del who, n
        bare = norm == 0
        extra = model.rule.smoothing
        model.empty_score = float((vote[bare] @ toxic[bare] + extra * model.share) / (vote[bare].sum() + extra))
        model.telling = _telling(rows, toxic, model.rule)
        if rows.size:
            index(model, rows, ids, toxic, vote)
            calibrate(model, rows, ids, toxic, vote)
        yield pa.RecordBatch.from_arrays([pa.array([_store_model(model)], pa.int64())], ["bytes"])
    return memory_returned(run)


def _telling(rows: Rows, toxic: np.ndarray, rule: Neighbours) -> np.ndarray:
    """Terms whose presence depends on the label: chi-squared, and a least ratio of the two classes' shares."""
    n1 = toxic.sum()
    n0 = len(toxic) - n1
    held = np.bincount(rows.at, minlength=rows.size)
    a = np.bincount(rows.at, toxic[rows.owner], minlength=rows.size)
    b = held - a
    ratio = (a + 0.5) / (n1 + 1) / ((b + 0.5) / (n0 + 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = (n1 + n0) * (a * (n0 - b) - b * (n1 - a)) ** 2 / (n1 * n0 * held * (n1 + n0 - held))
    fit = np.flatnonzero((held >= rule.min_examples) & (held < n1 + n0) & (np.maximum(ratio, 1 / ratio) >= rule.min_ratio)
                         & (chi2 >= rule.min_chi2))
    out = np.zeros(rows.size, dtype=bool)
    out[fit] = True
    return out


def _count_terms(shards: int):
    """How many texts hold each term, packed for the range shards of the terms' hashes."""
    def flush(parts: list[tuple[np.ndarray, np.ndarray]], total: int) -> pa.RecordBatch:
        (h,), (c,) = _sum_by((np.concatenate([p[0] for p in parts]),), np.concatenate([p[1] for p in parts]))
        return _batch([(s, WORDS, pack(delta(h[part]), _smallest(c[part]))) for s, part in _shards(h, shards)]
                      + [(0, TALLY, pack(np.array([total], np.int64)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, total = [], 0, 0
        for piece in slices(batches, limit=SLICE):
            distinct, _, which, _ = _counted(*terms(piece.column("text")))
            parts.append((distinct, np.bincount(which, minlength=len(distinct))))
            held += len(distinct)
            total += piece.num_rows
            if held >= TERMS_AT_ONCE:
                yield flush(parts, total)
                parts, held, total = [], 0, 0
        if parts:
            yield flush(parts, total)
    return memory_returned(run)


def _store_terms(folder: str, vocabulary):
    """Final frequencies of one shard, stored; those of the vocabulary go on, and the number of texts (at -1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, total, shard = [], [], 0, -1
        for batch in batches:
            for s, kind, payload in zip(batch.column("shard").to_pylist(), batch.column("kind").to_pylist(),
                                        batch.column("payload")):
                got = unpack(payload.as_py())
                shard = s
                if kind == TALLY:
                    total += int(got[0][0])
                else:
                    hashes.append(undelta(got[0]))
                    counts.append(got[1].astype(np.int64))
        ats, ns = [-1], [total]
        if hashes:
            (h,), (c,) = _sum_by((np.concatenate(hashes),), np.concatenate(counts))
            _store(folder, f"terms-{shard:05d}", h, _smallest(c))
            _, at, spot = np.intersect1d(vocabulary.value, h, assume_unique=True, return_indices=True)
            ats, ns = [-1, *at], [total, *c[spot]]
        yield pa.RecordBatch.from_arrays([pa.array(ats, pa.int64()), pa.array(ns, pa.int64())], ["at", "n"])
    return memory_returned(run)


def _document_frequency(texts: DataFrame, vocabulary: np.ndarray) -> tuple[str, int, int, np.ndarray]:
    """Store in how many of all documents each term is: (folder, shards, documents, frequencies of the vocabulary)."""
    spark = texts.sparkSession
    shards = shuffle_partitions(spark)
    folder = scratch_path(spark, "term-frequencies")
    if ":" not in folder.split("/")[0]:
        folder = f"file://{folder}"
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root)
    held = spark.sparkContext.broadcast(vocabulary)
    counted = texts.select("text").mapInArrow(_count_terms(shards), PACKED).repartitionById(shards, F.col("shard"))
    got = write_scratch(counted.mapInArrow(_store_terms(folder, held), "at long, n long"), "vocabulary-frequencies").toArrow()
    at, n = got["at"].to_numpy(), got["n"].to_numpy()
    df = np.zeros(len(vocabulary), np.int64)
    df[at[at >= 0]] = n[at >= 0]
    return folder, shards, int(n[at < 0].sum()), df


def _score(given: Model | StoredModel):
    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = given.load() if isinstance(given, StoredModel) else given
        for low in range(0, piece.num_rows, 512):
            part = piece.slice(low, 512)
            own = part.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            rows = model.rows(part.column("text"))
            sims, spots = nearest(model, rows, own)
            score = scores(model, rows, sims, spots)
            sims, spots = sims[:, :model.rule.evidence], spots[:, :model.rule.evidence]
            have = spots >= 0
            offsets = np.concatenate([[0], np.cumsum(have.sum(axis=1))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (
                model.ids[spots[have]] if have.any() else np.zeros(0, np.int64), sims[have])]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(score), *lists],
                [*part.schema.names, "score", "neighbours", "similarities"])
    return run


def score_toxicity(docs: DataFrame, model: Model | StoredModel, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text and the columns ``keep``, with score, predicted, and the evidence.

    ``neighbours`` holds the doc_ids of the nearest ``rule.evidence`` examples,
    nearest first (ties: smaller id), ``similarities`` their cosines.  A text that shares
    no term with an example, such as a null or empty one, gets the share among
    examples without terms.  Repeated rows score alike; other columns
    are left out; an empty table gives no rows.
    """
    chosen = docs.select("doc_id", "text", *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields)
    scored = map_slices(chosen, _score(model), schema + ", score double, neighbours array<long>, similarities array<double>",
                        limit=SLICE)
    return scored.withColumn("predicted", (F.col("score") >= model.rule.reject_at).cast("int"))
