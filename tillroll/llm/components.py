"""Connected components of a graph given by its edges, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import write_scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie every neighbour of u (larger ones, or all smaller ones and u itself) to u's smallest neighbour."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = both.join(low, "u")
    if large:
        out = tied.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node that it reaches.

    ``edges`` has columns u, v (long); loops and repeats are allowed and an
    empty graph gives no rows.  Alternating large and small stars: each round
    is a few joins on the edges alone, and the number of rounds grows with
    the logarithm of the longest path.  Rounds end when the edges are stars.
    """
    now = write_scratch(edges.filter("u <> v"), "edges")
    while not _are_stars(now):
        now = write_scratch(_star(_star(now, large=True), large=False), "edges")
    return now.select(F.explode(F.array("u", "v")).alias("node"), F.least("u", "v").alias("root")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge ties a node to the smallest of its component: no larger end stands in a second edge."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.greatest("u", "v").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.least("u", "v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    return not ends.groupBy("node").agg(F.sum("up").alias("ups"), F.max("down").alias("down")) \
        .filter("ups > 1 or (ups = 1 and down = 1)").limit(1).count()


class Forest:
    """Connected components of a few nodes within one task."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def apart(self, x, y) -> bool:
        return self.root(x) != self.root(y)

    def join(self, x, y) -> None:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
