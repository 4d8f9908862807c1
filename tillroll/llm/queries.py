"""Registered queries opN_<name> over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import lexical_rank, mixture, spelling
from tillroll.llm.fingerprints import fingerprint_edits
from tillroll.llm.frames import shuffle_partitions
from tillroll.llm.jaccard_join import jaccard_join
from tillroll.llm.link_sql import links_sql
from tillroll.llm.lm_score import score_texts, train
from tillroll.llm.minhash_dedup import minhash_dedup
from tillroll.llm.quality import classify_quality
from tillroll.llm.secret_scan import scan_secrets
from tillroll.llm.sentence_pieces import encode_pieces
from tillroll.llm.token_trees import apply_edits, store_trees
from tillroll.llm.top_k import top_k, whole_vectors
from tillroll.llm.toxicity import learn, score_toxicity
from tillroll.session import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES = {}
ORACLES = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int) -> Column:
    """crc32 of doc_id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(parts))


def training_labels(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    return table(spark, sf_dir, "labels").filter(fold(5) != 0).select("doc_id", F.col(column).alias("label"))


@register("op1_lm_scores")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs.filter(fold(7) != 2), order=3)
    return score_texts(docs, model).select(
        "doc_id", (fold(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "perplexity")


@register("op2_sentence_pieces")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_pieces(table(spark, sf_dir, "documents"), PIECES, add_eos=True, decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        F.xxhash64("begins", "ends").alias("spans_hash"))


@register("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of every text stored, then a table of edits: 20 code points in the middle replaced by the first 20, a new start."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = store_trees(docs, BYTE_PAIRS, public_tokenizers.PATTERN, scratch_path(spark, "token-trees"), shuffle_partitions(spark))
    half = F.floor(F.length("text") / 2)
    edits = docs.filter("doc_id is not null and text is not null").groupBy("doc_id").agg(F.min(F.struct(
        half.alias("start"), F.left("text", F.lit(20)).alias("replacement"))).alias("m")).select("doc_id", F.inline(F.array(
            F.struct(F.lit(1).alias("seq"), F.col("m.start").alias("start"), (F.col("m.start") + 20).alias("end"),
                     F.col("m.replacement").alias("replacement")),
            F.struct(F.lit(2).alias("seq"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"),
                     F.lit("New: ").alias("replacement")))))
    counted = apply_edits(trees, edits, BYTE_PAIRS, public_tokenizers.PATTERN)
    at = lambda column, k, other: F.coalesce(F.get(column, F.lit(k)), other)
    first, none = F.col("first_tokens"), F.lit(0).cast("long")
    return counted.select("doc_id", first.alias("n_tokens"), F.col("first_pretokens").alias("n_pretokens"),
                          at("after", 0, first).alias("n_tokens_middle"), at("after", 1, first).alias("n_tokens_front"),
                          at("reencoded", 0, none).alias("reencoded_middle"), at("reencoded", 1, none).alias("reencoded_front"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@register("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"), count("novel"))


@register("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents")).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@register("op6_top_k", """
WITH v AS (
  SELECT vec_id, [CAST(floor(256.0 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x)]) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


@register("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify_quality(table(spark, sf_dir, "documents"), training_labels(spark, sf_dir, "quality"))
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


@register("op8_mixture", mixture.ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


@register("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, learn(docs, training_labels(spark, sf_dir, "toxic")))
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted", "neighbours", "similarities")


@register("op10_jaccard_join", links_sql(5, 75, 100, """n.doc_id, n.n AS n_shingles,
  coalesce(c.component, n.doc_id) AS component_id, coalesce(g.links, 0) AS n_links"""))
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


@register("op11_minhash_dedup", links_sql(3, 85, 100, """n.doc_id, n.n AS n_shingles,
  coalesce(c.component, n.doc_id) AS component_id, n.doc_id IS NOT DISTINCT FROM coalesce(c.component, n.doc_id) AS kept"""))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(table(spark, sf_dir, "documents"))


@register("op12_spelling_variants", spelling.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@register("op13_lexical_rank", lexical_rank.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_rank.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
