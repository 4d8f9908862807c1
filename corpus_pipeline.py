"""A training corpus from documents: clean, deduplicate, redact, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; each result is written and read again before the next.
Empty tables pass through all stages; repeated rows, null texts and extra
columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm import mixture
from tillroll.llm.frames import write_scratch
from tillroll.llm.jaccard_join import jaccard_join
from tillroll.llm.queries import PIECES, training_labels
from tillroll.llm.secret_scan import redact, scan_secrets
from tillroll.llm.sentence_pieces import encode_pieces
from tillroll.llm.toxicity import learn, score_toxicity


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id, source, text, and the whole row but the text as one column: no name can clash with a new one."""
    rest = [c for c in docs.columns if c != "text"]
    return docs.select("doc_id", "source", "text", F.struct(*rest).alias("row"))


def _restored(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    return rows.select(*[changed.get(c, F.col("text") if c == "text" else F.col(f"row.`{c}`")).alias(c)
                         for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = learn(docs, training_labels(spark, sf_dir, "toxic"))
    return _restored(score_toxicity(_carried(docs), model, keep=("row",)).filter("predicted = 0"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of links stays: the one of the smallest doc_id, a null id after all others.

    Rows are joined by a hash of id and text, so one id may have several
    texts, and rows without an id take part like any others.  Of rows alike in
    id and text one stays; rows without words link with nothing and stay.
    """
    numbered = _carried(docs).withColumn("number", F.xxhash64("doc_id", "text"))
    groups = jaccard_join(numbered.select("number", "text"), id_col="number").select(
        F.col("doc_id").alias("number"), F.col("component_id").alias("group")).distinct()
    firsts = numbered.select("number", "doc_id").distinct().join(groups, "number").groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "number")).alias("first"))
    alike = Window.partitionBy("number", "doc_id", F.md5("text")).orderBy("number")
    one_each = numbered.withColumn("copy", F.row_number().over(alike)).filter("copy = 1")
    return _restored(one_each.join(firsts.select(F.col("first.number").alias("number")), "number", "left_semi"), docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every reported span gives way to the name of its kind; n_chars follows the text."""
    found = scan_secrets(_carried(docs), keep=("row",))
    any_span = F.size("spans") > 0
    return _restored(found, docs, text=F.when(any_span, redact()).otherwise(F.col("text")),
                     n_chars=F.when(any_span, F.length(redact()).cast("long")).otherwise(F.col("row.n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, once a row."""
    drawn = mixture.sized(_carried(docs))
    sizes = write_scratch(drawn.select("doc_id", "source", "size", "draw", "place"), "sizes")
    taken = mixture.with_repeats(drawn, mixture.source_plan(sizes)).filter("repeats > 0")
    return _restored(taken.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("repeats")))), docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a digest of what they decode to."""
    decoded = encode_pieces(docs, PIECES, keep=("doc_id", "lang", "source"), decoded=True)
    return decoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix),
          ("pieces", pieces)]

# Neighbour votes, compressed sizes and merges are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
