"""Document fingerprints by consistent weighted sampling.

A text is the weighted set of its words (weight: count).  For each of ``k``
samples every weighted term gets, from its hash alone, r and c of
Gamma(2, 1) and b of [0, 1); with t = floor(ln(weight) / r + b) its key is
c * exp(-r * (t - b + 1)), and the term of the smallest key, with its t, is
the sample.  Two texts agree in a sample with a probability that equals their
generalised Jaccard similarity, the sum of smaller weights over the sum of
larger ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import shuffle_partitions, slices
from tillroll.llm.words import mix, split_words

SAMPLES = 64
_U = np.uint64
_CELLS = 2 << 20             # keys held at once


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def _keys(terms: np.ndarray, counts: np.ndarray, low_k: int, high_k: int) -> np.ndarray:
    """Per weighted term and sample: the key's order in the high half, the sample's identity in the low half."""
    seeds = mix(np.arange(low_k + 1, high_k + 1, dtype=_U))
    x = mix(terms[:, None] ^ seeds[None, :])
    y = mix(x + _U(0xD1B54A32D192ED03))
    half, low = _U(32), _U(0xFFFFFFFF)
    unit = lambda v: (v.astype(np.float64) + 0.5) * 2.0 ** -32
    r = -np.log(unit(x >> half) * unit(x & low))
    log_c = np.log(-np.log(unit(y >> half) * unit(y & low)))
    b = _uniform(mix(y ^ x))
    t = np.floor(np.log(counts)[:, None] / r + b)
    key = (log_c - r * (t - b + 1)).astype(np.float32).view(np.int32)
    ordered = np.where(key < 0, ~key, key | np.int32(-2 ** 31)).view(np.uint32).astype(_U)
    identity = mix(x + t.astype(np.int64).view(_U) * _U(0x9E3779B97F4A7C15)) & low
    return ordered << half | identity


def signatures(column: pa.Array, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """(texts x samples) uint16 signature, and which texts have any word."""
    words = split_words(column)
    n = len(words.first) - 1
    owner = np.repeat(np.arange(n), words.counts)
    h = words.hashes()
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(h)))
    h, owner = h[at], owner[at]
    # Equal (term, count) pairs of different texts share their keys.
    pair = mix(h + counts.astype(_U) * _U(0xBF58476D1CE4E5B9))
    _, where, which = np.unique(pair, return_index=True, return_inverse=True)
    term, count = h[where], counts[where]
    out = np.full((n, samples), np.iinfo(np.uint64).max, dtype=_U)
    first = np.searchsorted(owner, np.arange(n + 1))
    step = max(1, 8 * _CELLS // max(1, len(where)))
    for k in range(0, samples, step):                # some samples at a time: the keys of a slice stay small
        part = _keys_of(term, count, k, min(k + step, samples))
        low = 0
        while low < n:
            high = max(low + 1, int(np.searchsorted(first, first[low] + _CELLS // part.shape[1], side="right")) - 1)
            texts = low + np.flatnonzero(np.diff(first[low:high + 1]))
            if len(texts):
                rows = part[which[first[low]:first[high]]]
                out[texts, k:k + part.shape[1]] = np.minimum.reduceat(rows, first[texts] - first[low], axis=0)
            low = high
    return (out & _U(0xFFFF)).astype(np.uint16), np.diff(first) > 0


def _keys_of(term: np.ndarray, count: np.ndarray, low: int, high: int) -> np.ndarray:
    out = np.empty((len(term), high - low), dtype=_U)
    rows = max(1, _CELLS // 8 // (high - low))
    for a in range(0, len(term), rows):
        out[a:a + rows] = _keys(term[a:a + rows], count[a:a + rows], low, high)
    return out


def as_text(signature: np.ndarray, have: np.ndarray) -> list[str]:
    return [row.tobytes().hex() if h else "" for row, h in zip(signature.astype(">u2"), have)]


def likeness(a: np.ndarray, b: np.ndarray, have_a: np.ndarray, have_b: np.ndarray) -> np.ndarray:
    """Share of equal samples; two texts without words are alike, one with and one without are not."""
    both = (a == b).mean(axis=1) if len(a) else np.zeros(0)
    return np.where(have_a & have_b, both, (have_a == have_b).astype(float))


def fingerprint_texts(docs: DataFrame, text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """doc_id and ``fingerprint``, 4 hex digits per sample; "" for null, empty and blank texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(as_text(*signatures(piece.column("text"), samples)), pa.string())],
                ["doc_id", "fingerprint"])
    return docs.select(F.col("doc_id").cast("long"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string")


def in_order_with_successor(docs: DataFrame) -> DataFrame:
    """(part, border, doc_id, text) by descending doc_id within part; the border row follows the part's last row.

    Texts cross the shuffle once, by ranges of doc_id; beside them each part
    gets one copy, the first document of the part after it.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = sorted(set(texts.agg(F.percentile_approx(
        "doc_id", [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0] or []))
    ranges = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    part = F.coalesce(F.size(F.filter(ranges, lambda b: b < F.col("doc_id"))), F.lit(0))
    placed = texts.withColumn("part", part)
    # One row per part: its largest id begins the part, and follows the last row of the part above.
    tops = {r["part"]: r["top"] for r in placed.groupBy("part").agg(F.max("doc_id").alias("top")).collect()}
    have = sorted(tops)
    after = [(p, tops[have[k - 1]]) for k, p in enumerate(have) if tops[have[k - 1]] is not None]
    border = F.broadcast(spark.createDataFrame(after, "part int, doc_id long"))
    copies = texts.join(border, "doc_id").groupBy("part", "doc_id").agg(F.min("text").alias("text"))
    rows = placed.select("part", F.lit(0).alias("border"), "doc_id", "text").unionByName(
        copies.select("part", F.lit(1).alias("border"), "doc_id", "text"))
    return rows.repartitionById(parts, F.col("part")).sortWithinPartitions(
        "part", "border", F.desc_nulls_last("doc_id"), "text")


def _edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def fingerprint_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, text, edited, fingerprint, edited_fingerprint, near_edited, near_next.

    ``edited``: the last third of the text replaced by as many code points
    from the start of the next document by descending doc_id (after the last,
    the first).  A null text is empty.  Rows of one doc_id follow each other
    by text, and a row's successor may be its repetition; null ids come
    last.  A single row is its own successor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, opening = [], None
        for piece in slices(batches, limit=4 << 20):
            borders = piece.column("border").to_pylist()
            rows = list(zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()))
            opening = rows[0][1] if opening is None else opening
            own = borders.count(0)
            rows, ends = held + rows[:own], own < len(borders)
            held = []
            if ends:
                yield from work(rows, piece.column("text")[own].as_py())
                return
            if len(rows) > 1:
                yield from work(rows[:-1], rows[-1][1])
            held = rows[-1:]
        if held:
            yield from work(held, opening)

    def work(rows, following) -> Iterator[pa.RecordBatch]:
        if not rows:
            return
        texts = [t for _, t in rows]
        edited = [_edited(t, n) for t, n in zip(texts, [*texts[1:], following])]
        n = len(rows)
        sig, have = signatures(pa.array([*texts, following, *edited], pa.large_string()), samples)
        mine, mine_have, new, new_have = sig[:n], have[:n], sig[n + 1:], have[n + 1:]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in rows], pa.int64()), pa.array(texts, pa.string()), pa.array(edited, pa.string()),
             pa.array(as_text(mine, mine_have)), pa.array(as_text(new, new_have)),
             pa.array(likeness(mine, new, mine_have, new_have)),
             pa.array(likeness(mine, sig[1:n + 1], mine_have, have[1:n + 1]))],
            ["doc_id", "text", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    return in_order_with_successor(docs).mapInArrow(
        run, "doc_id long, text string, edited string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
