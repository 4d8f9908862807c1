"""Mixing sources to target weights by capped water-filling.

Sources share the size of the whole corpus by weight; a source stops at
``cap`` times its own size and its excess is shared out again by weight,
until none is above.  A source's target becomes whole repetitions of all its
documents and a seeded sample of one more, cut where the running size comes
nearest to what is left.

Only sizes move: the text is read once to count words, and each row draws a
seeded hash of its id and text.  The cut of each source is found from sums:
over 4,096 ranges of the hash, over the hashes inside one range, over the
input partitions of the rows that have the last hash (rows alike in id and
text, which may be many), and row by row inside one of those.  Rows then
compare their own draw and place with the cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.frames import write_scratch

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """docs with ``size`` (words, null text 0), ``draw`` (hash of seed, doc_id and text, hex) and ``place``.

    ``place`` tells rows of one draw apart: such rows are alike, so it does
    not matter which of them it puts first.
    """
    return docs.withColumns({
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        "draw": F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"),
                               F.md5(F.coalesce("text", F.lit(""))))),
        "place": F.monotonically_increasing_id(),
    })


def _ranked(totals: DataFrame) -> DataFrame:
    """``place`` of each source from 0, by code point, null last; no task holds more than a range."""
    spark = totals.sparkSession
    ranged = write_scratch(
        totals.repartitionByRange(F.asc_nulls_last("source")).sortWithinPartitions(F.asc_nulls_last("source"))
        .withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("at", 33)
    counts = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # One row per partition of the sort, a number that the settings fix.
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return ranged.withColumn("part", part).join(before, "part").select(
        "source", "source_size", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("place"))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> with weight and target.

    Every round is one small aggregation over the sources; sources once
    clamped stay clamped, so rounds end.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    now = write_scratch(_ranked(totals).select("source", "source_size", weight.cast("long").alias("weight"),
                                               (F.col("source_size") * cap).alias("most")), "weights")
    everything = now.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = 0.0, -1
    while True:
        above = F.col("most") < F.lit(level) * F.col("weight")
        held, held_size, open_weight = now.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if held == clamped or not open_weight:
            break
        clamped, level = held, (everything - held_size) / open_weight
    above = F.col("most") < F.lit(level) * F.col("weight")
    return now.select("source", "source_size", "weight",
                      F.when(above, F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight")).alias("target"))


def _border(sums: DataFrame, at: DataFrame, name: str) -> DataFrame:
    """(source, name, before, more): of each source's parts, the one within which its running size reaches ``more``.

    ``sums`` has source, name and inside; ``at`` has source, before (the size
    ahead of all these parts) and more, one row per source.
    """
    reach = Window.partitionBy("source").orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
    ranged = sums.withColumn("start", F.sum("inside").over(reach) - F.col("inside")).withColumnRenamed("source", "_s")
    start = F.col("before") + F.col("start")
    return ranged.join(at, F.col("_s").eqNullSafe(F.col("source"))) \
        .filter((start <= F.col("more")) & (start + F.col("inside") > F.col("more"))) \
        .select("source", name, start.alias("before"), "more")


def _met(rows: DataFrame, border: DataFrame, *names: str) -> DataFrame:
    """``rows`` that lie in their source's border part; its names are in both."""
    same = F.col("source").eqNullSafe(F.col("_s"))
    for n in names:
        same = same & (F.col(n) == F.col(f"_{n}"))
    few = border.select(F.col("source").alias("_s"), *[F.col(n).alias(f"_{n}") for n in names])
    return rows.join(few, same, "left_semi")


def source_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, size, draw, place) of all rows -> one row per source with target, whole and the last draw and place taken.

    Rows are added up per draw and input partition before anything is joined,
    so rows of one draw, however many, count as one row a partition.
    """
    aims = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    aims = aims.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(0).cast("int"))
    aims = write_scratch(aims.withColumn("more", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    sizes = sizes.withColumn("part", F.shiftright("place", 33))
    parts = write_scratch(sizes.groupBy("source", "draw", "part").agg(F.sum("size").alias("inside")), "parts") \
        .withColumn("bucket", F.substring("draw", 1, 3))
    added = lambda rows, name: rows.groupBy("source", name).agg(F.sum("inside").alias("inside"))
    at = aims.select("source", F.lit(0).cast("long").alias("before"), "more")
    at = write_scratch(_border(added(parts, "bucket"), at, "bucket"), "border")
    at = write_scratch(_border(added(_met(parts, at, "bucket"), "draw"), at, "draw"), "border")
    draws = at.select("source", "draw")
    at = write_scratch(_border(added(_met(parts, at, "draw"), "part"), at, "part").join(
        draws.select(F.col("source").alias("_s"), "draw"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "border")
    # What is left are rows of one draw in one input partition.
    order = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = _met(sizes, at, "draw", "part").withColumn("start", F.sum("size").over(order) - F.col("size")) \
        .select(F.col("source").alias("_s"), "place", "start", "size")
    nearest = F.col("before") + F.col("start") + F.col("size") / 2 <= F.col("more")
    cuts = rows.join(at, F.col("_s").eqNullSafe(F.col("source"))).groupBy("_s", "draw").agg(
        F.coalesce(F.max(F.when(nearest, F.col("place"))), F.min("place") - 1).alias("cut_place"))
    return aims.join(cuts.withColumnRenamed("draw", "cut"), F.col("_s").eqNullSafe(F.col("source")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("cut", F.lit("")).alias("cut"),
        F.coalesce("cut_place", F.lit(-1)).alias("cut_place"))


def with_repeats(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows (source, draw, place, ...) with source_size, target and ``repeats``, how often the mix takes each.

    A source may hold a third of all rows: rows meet their source's one row of
    the plan by source and a hash of their place, 256 parts each.
    """
    part = F.pmod(F.xxhash64("place"), F.lit(256))
    aims = plan.withColumnRenamed("source", "_mix_source").withColumn("_mix_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(255))))
    taken = (F.col("draw") < F.col("cut")) | ((F.col("draw") == F.col("cut")) & (F.col("place") <= F.col("cut_place")))
    same = F.col("source").eqNullSafe(F.col("_mix_source")) & (part == F.col("_mix_part"))
    return rows.join(aims, same).withColumn("repeats", F.col("whole") + taken.cast("int")) \
        .drop("_mix_source", "_mix_part", "whole", "cut", "cut_place")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats of every document.

    Null and empty texts have size 0 and are taken like others of their
    source; null sources form one source, ranked last.  Rows of one id or of
    none draw for themselves, by their text; rows alike in id and text each
    count, and as many of them are taken as come nearest to the target.
    If all sizes are 0, targets are 0.  An empty table gives no rows.
    """
    sizes = write_scratch(sized(docs.select("doc_id", "source", "text"), seed).drop("text"), "sizes")
    return with_repeats(sizes, source_plan(sizes, weights, cap)).drop("draw", "place")


ORACLE = r"""
WITH sizes AS (
  SELECT row_number() OVER () AS r, doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS draw
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT source, source_size, 3 * source_size AS most,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM totals),
lined AS (
  SELECT *, row_number() OVER w AS k, CAST(sum(most) OVER w AS BIGINT) - most AS held,
         CAST(sum(weight) OVER () AS BIGINT) - CAST(sum(weight) OVER w AS BIGINT) + weight AS open,
         CAST(sum(source_size) OVER () AS BIGINT) AS everything
  FROM weighted
  WINDOW w AS (ORDER BY most / CAST(weight AS DOUBLE), source NULLS LAST ROWS UNBOUNDED PRECEDING)),
levels AS (SELECT *, (everything - held) / CAST(open AS DOUBLE) AS level FROM lined),
chosen AS (SELECT level FROM levels WHERE level * weight <= most ORDER BY k LIMIT 1),
aims AS (
  SELECT source, source_size,
         CASE WHEN most < level * weight THEN CAST(most AS DOUBLE) ELSE level * weight END AS target
  FROM (SELECT w.source, w.source_size, w.most, w.weight, c.level FROM weighted w, chosen c)),
parts AS (
  SELECT *, target - whole * source_size AS more
  FROM (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole
        FROM aims)),
run AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.more, s.source, row_number() OVER w AS k,
         CAST(sum(s.size) OVER w AS BIGINT) - s.size AS start
  FROM sizes s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
  WINDOW w AS (PARTITION BY s.source ORDER BY s.draw, s.r ROWS UNBOUNDED PRECEDING)),
cuts AS (SELECT source, max(k) AS cut FROM run WHERE start + size / 2.0 <= more AND source_size > 0 GROUP BY source)
SELECT r.doc_id, r.size, r.source_size, r.target,
       r.size * (r.whole + CASE WHEN r.k <= c.cut THEN 1 ELSE 0 END) AS taken
FROM run r LEFT JOIN cuts c ON r.source IS NOT DISTINCT FROM c.source
"""
