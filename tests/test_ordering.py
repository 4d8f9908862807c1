"""Distributed rank / running sums / lag equal the single-partition windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.plans.ordering import with_rank, with_sequence


def test_rank_matches_window_rank_with_ties(spark):
    rnd = random.Random(7)
    rows = [(f"k{i}", float(rnd.randint(0, 40))) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double")
    ours = {r.k: r.rnk for r in with_rank(df, "v", "rnk").collect()}
    ref = {r.k: r.rnk for r in df.withColumn("rnk", F.rank().over(Window.orderBy(F.desc("v")))).collect()}
    assert ours == ref


def test_sequence_running_total_and_lag(spark):
    rnd = random.Random(3)
    rows = [(i * 3 + rnd.randint(0, 2), rnd.randint(-50, 100)) for i in range(1500)]
    df = spark.createDataFrame(rows, "d long, v long")
    ours = {r.d: (r._idx, r.run, r.prev) for r in
            with_sequence(df, "d", "v", running="run", previous="prev").collect()}
    w = Window.orderBy("d")
    ref = {r.d: (r.i, r.run, r.prev) for r in df.select(
        "d", (F.row_number().over(w) - 1).alias("i"), F.sum("v").over(w).alias("run"),
        F.lag("v").over(w).alias("prev")).collect()}
    assert ours == ref


def test_sequence_with_null_key_first(spark):
    rows = [(None, 5), (1, 7), (2, -3), (4, 10)]
    df = spark.createDataFrame(rows, "d long, v long")
    ours = {r.d: (r._idx, r.run, r.prev) for r in
            with_sequence(df, "d", "v", running="run", previous="prev").collect()}
    assert ours == {None: (0, 5, None), 1: (1, 12, 5), 2: (2, 9, 7), 4: (3, 19, -3)}
