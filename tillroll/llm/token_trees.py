"""Token counts kept up to date in a table of segment trees.

``store_trees`` encodes every text once and writes, per document, the text, its
count and its packed tree: the code points and tokens of each pre-token, by
segments.  ``apply_edits`` joins a table of edits to it, also in a later
application (``open_trees``), and encodes anew only the pre-tokens that an edit
touches; the sums above them follow (``token_counts.TokenTree``).

The table is bucketed by doc_id, so edits travel to the documents and texts
stay where they are: the join shuffles the edits alone (with fewer buckets than
``spark.sql.shuffle.partitions``, Spark prefers to shuffle both sides).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.frames import map_slices, pack, unpack
from tillroll.llm.token_counts import TokenTree, _counter

COLUMNS = "doc_id long, text string, tree binary, n_tokens long, n_pretokens long"
EDITS = "doc_id long, seq int, start long, end long, replacement string"


def _packed(tree: TokenTree) -> bytes:
    flat = lambda parts: np.array([x for s in parts for x in s], np.uint32)
    small = lambda a: a.astype(np.uint8) if a.max(initial=0) < 256 else a
    return pack(np.array([len(s) for s in tree.lengths], np.uint32), small(flat(tree.lengths)), small(flat(tree.counts)))


def _unpacked(value: bytes) -> TokenTree:
    sizes, lengths, counts = unpack(value)
    ends = np.cumsum(sizes)
    cut = lambda a: [a[e - n:e].tolist() for n, e in zip(sizes.tolist(), ends.tolist())]
    tree = TokenTree.__new__(TokenTree)
    tree._fill(cut(lengths), cut(counts))
    return tree


def _table(path: str) -> str:
    return "token_trees_" + hashlib.sha256(path.encode()).hexdigest()[:16]


def store_trees(docs: DataFrame, ranks_path: str, pattern: str, path: str, buckets: int) -> DataFrame:
    """Write the trees of all texts to ``path``, in ``buckets`` by doc_id; the table.

    A null text counts as empty; repeated rows and null ids each give a row;
    other columns are left out.
    """
    with open(ranks_path, "rb") as f:
        ranks = f.read()

    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks, pattern)
        texts = [t or "" for t in piece.column("text").to_pylist()]
        trees, totals, sizes = [], [], []
        for text in texts:
            parts = counter.pattern.findall(text)
            tree = TokenTree(list(map(len, parts)), counter.counts(parts))
            trees.append(_packed(tree))
            totals.append(tree.total)
            sizes.append(len(parts))
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(texts, pa.string()), pa.array(trees, pa.binary()), pa.array(totals, pa.int64()),
             pa.array(sizes, pa.int64())], ["doc_id", "text", "tree", "n_tokens", "n_pretokens"])
    made = map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, COLUMNS, limit=4 << 20)
    made.write.option("path", path).option("compression", "zstd").bucketBy(buckets, "doc_id") \
        .format("parquet").mode("overwrite").saveAsTable(_table(path))
    return docs.sparkSession.table(_table(path))


def open_trees(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The table that ``store_trees`` wrote to ``path``, in this or an earlier application."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_table(path)} ({COLUMNS}) USING parquet "
              f"CLUSTERED BY (doc_id) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(_table(path))


def apply_edits(trees: DataFrame, edits: DataFrame, ranks_path: str, pattern: str, touched_only: bool = False) -> DataFrame:
    """The rows of ``trees`` after ``edits``, with arrays ``after`` and ``reencoded``, an entry per edit.

    ``edits`` has doc_id, seq, start, end and replacement: those of a document
    are applied in order of seq, each to the text that the ones before it
    left, bounds clipped to it, a null replacement being empty.  All rows of
    an id get its edits; a null id has none; edits of unknown ids do nothing.
    ``n_tokens``, ``text`` and ``tree`` are those afterwards, ``first_tokens``
    and ``first_pretokens`` the counts before.  ``touched_only`` leaves out
    documents without edits: what is to be written in place of their rows.
    """
    with open(ranks_path, "rb") as f:
        ranks = f.read()
    mine = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "start", "end", "replacement"))).alias("edits"))
    met = trees.join(mine, "doc_id", "inner" if touched_only else "left")

    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks, pattern)
        out = {name: [] for name in ("text", "tree", "n_tokens", "n_pretokens", "after", "reencoded")}
        for text, packed, n, sizes, some in zip(*(piece.column(c).to_pylist() for c in (
                "text", "tree", "n_tokens", "n_pretokens", "edits"))):
            after, again = [], []
            if some:
                tree = _unpacked(packed)
                for e in some:
                    start = min(max(0, e["start"]), len(text))
                    text, count = tree.edit(text, start, min(max(start, e["end"]), len(text)), e["replacement"] or "", counter)
                    after.append(tree.total)
                    again.append(count)
                packed, n, sizes = _packed(tree), tree.total, sum(map(len, tree.lengths))
            for name, value in zip(out, (text, packed, n, sizes, after, again)):
                out[name].append(value)
        longs = pa.list_(pa.int64())
        kinds = [pa.string(), pa.binary(), pa.int64(), pa.int64(), longs, longs]
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), *[pa.array(v, k) for v, k in zip(out.values(), kinds)],
             piece.column("n_tokens"), piece.column("n_pretokens")],
            ["doc_id", *out, "first_tokens", "first_pretokens"])
    return map_slices(met.select("doc_id", "text", "tree", "n_tokens", "n_pretokens", "edits"), run,
                      COLUMNS + ", after array<long>, reencoded array<long>, first_tokens long, first_pretokens long", limit=4 << 20)
