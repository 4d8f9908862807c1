"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a row of transformed statistics (shares of byte kinds, word
lengths, repetition), computed from its whole bytes.  The class means and
covariances are exact over all labelled rows: Spark adds up moments.  Each
covariance is shrunk towards the pooled one and towards a multiple of the
identity; its Cholesky factor is computed once, and a text's score is the
logistic of the difference of the two Gaussian log densities plus the log
ratio of the class sizes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import map_slices, write_scratch
from tillroll.llm.words import split_words

FEATURES = ("words", "word_length", "length_spread", "upper", "digit", "space", "line", "stop", "pipe", "mark",
            "symbol", "quote", "other_punctuation", "beyond_ascii", "distinct", "top_word", "symbol_end", "entropy")


@dataclass(frozen=True)
class Shrinkage:
    pooled: float = 0.2          # towards the pooled covariance
    identity: float = 0.05       # towards its mean variance times the identity


def _groups() -> np.ndarray:
    """(256 bytes x kinds) membership."""
    kinds = [range(65, 91), range(48, 58), [32, 9], [10, 13], b".,;:?", b"|", b"!", b"#$%&*@^~<>=+\\/_", b"\"'`()[]{}-",
             [b for b in range(33, 127) if not chr(b).isalnum()], range(128, 256)]
    out = np.zeros((256, len(kinds)))
    for k, members in enumerate(kinds):
        out[list(members), k] = 1
    return out


_GROUPS = _groups()
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:?'\")"]] = True


def _logit(share: np.ndarray) -> np.ndarray:
    return np.log((share + 0.002) / (1.002 - share))


def statistics(column: pa.Array) -> np.ndarray:
    """(texts x FEATURES); an empty text has no words and shares of 0."""
    words = split_words(column)
    n = len(words.first) - 1
    lengths = (words.ends - words.starts).astype(np.float64)
    owner = np.repeat(np.arange(n), words.counts)
    # Bytes of the text's words and the space between them.
    bounds = _text_bounds(column)
    histogram = np.zeros((n, 256))
    for i in range(n):
        histogram[i] = np.bincount(words.data[bounds[i]:bounds[i + 1]], minlength=256)
    size = np.maximum(histogram.sum(axis=1), 1)
    share = histogram @ _GROUPS / size[:, None]
    count = np.maximum(words.counts, 1)
    mean = np.bincount(owner, lengths, n) / count
    spread = np.sqrt(np.maximum(np.bincount(owner, lengths ** 2, n) / count - mean ** 2, 0))
    h = words.hashes()
    order = np.lexsort((h, owner))
    hs, os = h[order], owner[order]
    new = np.ones(len(hs), dtype=bool)
    new[1:] = (hs[1:] != hs[:-1]) | (os[1:] != os[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(hs)))
    distinct = np.bincount(os[at], minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, os[at], runs)
    symbol_end = np.bincount(owner, _PUNCT[words.data[words.ends - 1]] if len(owner) else None, n) / count
    p = histogram / size[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    # Distinct words fall with length even in good text: measured against a power of the length.
    fresh = np.log((distinct + 1) / (words.counts + 1) ** 0.85)
    return np.column_stack([
        np.log1p(words.counts), np.log1p(mean), np.log1p(spread), *(_logit(share[:, k]) for k in range(9)),
        _logit(share[:, 9]), _logit(share[:, 10]), fresh, _logit(top / count), _logit(symbol_end), entropy])


def _text_bounds(column: pa.Array) -> np.ndarray:
    from tillroll.llm.words import utf8_buffer
    return utf8_buffer(column)[1]


def _featured(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = statistics(piece.column("text"))
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), pa.array(rows.reshape(-1)))
    kept = [k for k, name in enumerate(piece.schema.names) if name != "text"]
    yield pa.RecordBatch.from_arrays([*[piece.column(k) for k in kept], lists],
                                     [*[piece.schema.names[k] for k in kept], "features"])


def with_statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``features`` of every row; null texts are empty, other columns are left out."""
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.drop("text").schema.fields)
    return map_slices(chosen, _featured, schema + ", features array<double>")


@dataclass(frozen=True)
class Discriminant:
    centre: np.ndarray
    scale: np.ndarray
    means: tuple            # of label 0, label 1
    factors: tuple          # inverses of the lower Cholesky factors
    log_dets: tuple
    log_odds: float
    constant: float | None  # the score, if there are not two classes to tell apart

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        z = (rows - self.centre) / self.scale
        logs = [-0.5 * (((z - m) @ inverse.T) ** 2).sum(axis=1) - 0.5 * det
                for m, inverse, det in zip(self.means, self.factors, self.log_dets)]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + self.log_odds, -500, 500)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per label the sums of products of (1, features), one entry a row."""
    d = len(FEATURES) + 1
    sums = {}
    for batch in batches:
        rows = batch.column("features").flatten().to_numpy().reshape(-1, d - 1)
        labels = batch.column("label").to_numpy()
        for label in np.unique(labels):
            x = np.column_stack([np.ones((labels == label).sum()), rows[labels == label]])
            sums[int(label)] = sums.get(int(label), 0) + x.T @ x
    for label, product in sums.items():
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(i), label, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
             pa.array(product[i, j])], ["label", "i", "j", "value"])


def fit(labelled: DataFrame, shrinkage: Shrinkage = Shrinkage()) -> Discriminant:
    """From rows (label 0/1, features).  With rows of one label alone the score is that label, with none 0.5."""
    d = len(FEATURES) + 1
    sums = labelled.select("label", "features").mapInArrow(_moments, "label int, i int, j int, value double") \
        .groupBy("label", "i", "j").agg(F.sum("value").alias("value")).collect()       # 2 x 190 numbers
    products = {label: np.zeros((d, d)) for label in (0, 1)}
    for r in sums:
        if r["label"] in products:
            products[r["label"]][r["i"], r["j"]] = products[r["label"]][r["j"], r["i"]] = r["value"]
    n = [products[k][0, 0] for k in (0, 1)]
    if not all(n):
        return Discriminant(None, None, (), (), (), 0.0, 0.5 if not any(n) else float(n[1] > 0))
    means = [products[k][0, 1:] / n[k] for k in (0, 1)]
    scatter = [products[k][1:, 1:] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    within = (scatter[0] + scatter[1]) / sum(n)
    scale = np.sqrt(np.maximum(np.diag(within), 1e-6))
    centre = (n[0] * means[0] + n[1] * means[1]) / sum(n)
    pooled = within / np.outer(scale, scale)
    out_means, factors, dets = [], [], []
    for k in (0, 1):
        own = scatter[k] / n[k] / np.outer(scale, scale)
        # Few rows say little about a covariance: their share of the pooled one grows.
        towards = max(shrinkage.pooled, (d - 1) / (n[k] + d - 1))
        s = (1 - towards) * own + towards * pooled
        s = (1 - shrinkage.identity) * s + shrinkage.identity * np.trace(s) / (d - 1) * np.eye(d - 1)
        lower = np.linalg.cholesky(s + 1e-9 * np.eye(d - 1))
        out_means.append((means[k] - centre) / scale)
        factors.append(np.linalg.inv(lower))
        dets.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(centre, scale, tuple(out_means), tuple(factors), tuple(dets), float(np.log(n[1] / n[0])), None)


def score_quality(featured: DataFrame, model: Discriminant, accept_at: float = 0.3) -> DataFrame:
    """``featured`` without the features, with score (0 to 1) and predicted; repeated rows score alike."""
    kept = [c for c in featured.columns if c != "features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(model.score(rows))],
                                             [*kept, "score"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in featured.drop("features").schema.fields)
    return featured.mapInArrow(run, schema + ", score double").withColumn(
        "predicted", (F.col("score") >= accept_at).cast("int"))


def classify_quality(docs: DataFrame, labels: DataFrame, shrinkage: Shrinkage = Shrinkage(),
                     accept_at: float = 0.3) -> DataFrame:
    """doc_id, score, predicted of every document, learned from ``labels`` (doc_id, label 0/1).

    Texts are read once: their statistics are stored and serve learning and
    scoring.  Rows without a label or id do not teach; a document with
    several label rows teaches each; other columns are left out.
    """
    featured = write_scratch(with_statistics(docs), "statistics")
    taught = featured.join(labels.filter("label in (0, 1)").select("doc_id", F.col("label").cast("int")), "doc_id")
    return score_quality(featured, fit(taught, shrinkage), accept_at)
