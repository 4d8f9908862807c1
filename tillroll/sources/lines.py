"""CSV records from the lines of files that are read in parallel.

A quoted field may hold line breaks, so a line need not be a record.  Whether
a line starts inside quotes depends on everything before it in its file.  It
is found without reading a file in one piece:

* a line is a function of its start state: it ends inside or outside quotes
  either way, keeps the state, or swaps it (``end_states``);
* such functions compose.  Within a split a running sum of swaps and the last
  line that fixes the state give the state behind every line; the splits of a
  file compose in the same way, a row each;
* a record starts at each line that starts outside quotes, and the lines up
  to the next start belong to it, also across splits.

Quotes count as pandas and Python's csv module count them: one opens a field
only at its start, two in a quoted field are one of its characters, and one
elsewhere is plain text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DIALECT = {"quote": '"', "escape": '"'}
_OUT, _IN, _CLOSED = 0, 1, 2


def read_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, length, modified, block, pos, value: every line between line feeds; pos grows within a split."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(files).select(
        meta["file_path"].alias("file"), meta["file_size"].alias("length"),
        meta["file_modification_time"].alias("modified"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("pos"), "value")


def _end_state(value: Column, start: int) -> Column:
    """1 if a line that starts in state ``start`` ends inside quotes, else 0."""
    parts = F.split(value, '"')

    def step(now, part):
        begins_field = F.endswith(part, F.lit(",")) | ((part == "") & (now["k"] == 0))
        behind_quote = (F.when(now["s"] == _IN, _CLOSED)
                        .when((now["s"] == _CLOSED) & (part == ""), _IN)        # "" inside quotes
                        .when(begins_field & ((now["s"] == _OUT) | F.endswith(part, F.lit(","))), _IN).otherwise(_OUT))
        last = now["k"] == F.size(parts) - 1
        return F.struct(F.when(last, F.when(now["s"] == _IN, _IN).otherwise(_OUT)).otherwise(behind_quote).alias("s"),
                        (now["k"] + 1).alias("k"))
    init = F.struct(F.lit(start).alias("s"), F.lit(0).alias("k"))
    return F.when(F.contains(value, F.lit('"')), F.aggregate(parts, init, step, lambda end: end["s"])).otherwise(start)


def end_states(lines: DataFrame) -> DataFrame:
    """``lines`` with ``out_end`` and ``in_end``: whether the line ends inside quotes if it starts outside, inside."""
    return lines.withColumns({"out_end": _end_state(F.col("value"), _OUT), "in_end": _end_state(F.col("value"), _IN)})


def _without_return(value: Column) -> Column:
    """A record without the carriage return of its line end."""
    return F.when(F.endswith(value, F.lit("\r")), F.left(value, F.length(value) - 1)).otherwise(value)


def is_blank(value: Column) -> Column:
    return F.trim(_without_return(value)) == ""


def whole_lines(lines: DataFrame) -> DataFrame:
    """Records of files in which no line ends inside quotes: the lines that are not blank."""
    return lines.filter(~is_blank(F.col("value"))).select(
        "file", "block", "pos", _without_return(F.col("value")).alias("record"))


def joined_lines(lines: DataFrame) -> DataFrame:
    """file, block, pos (of the first line), record, closed; ``lines`` are stored and have end states.

    The windows go over one split, and over the splits of one file, a row
    each.  ``closed`` is false if the file ends inside quotes.
    """
    split, file = Window.partitionBy("file", "block").orderBy("pos"), Window.partitionBy("file").orderBy("block")
    here = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    swap = ((F.col("out_end") == 1) & (F.col("in_end") == 0)).cast("int")
    fixed = F.when(F.col("out_end") == F.col("in_end"), F.col("out_end"))
    known = lines.withColumn("swaps", F.sum(swap).over(here)) \
        .withColumn("fixed", F.last((fixed + F.col("swaps")) % 2, True).over(here))
    # Splits as single lines: the state that a split fixes, or the swaps that it adds.
    splits = known.groupBy("file", "block").agg(F.max_by(F.struct("swaps", "fixed"), F.col("pos")).alias("end")) \
        .select("file", "block", (F.col("end.swaps") % 2).alias("swap"),
                ((F.col("end.fixed") + F.col("end.swaps")) % 2).alias("to"))
    splits = splits.withColumn("swap", F.when(F.col("to").isNull(), F.col("swap")).otherwise(0)) \
        .withColumn("swaps", F.sum("swap").over(file.rowsBetween(Window.unboundedPreceding, 0)))
    state = (F.coalesce(F.last((F.col("to") + F.col("swaps")) % 2, True).over(
        file.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)) + F.col("swaps")) % 2
    splits = splits.withColumn("ends", state).select(
        "file", "block", F.coalesce(F.lag("ends").over(file), F.lit(0)).alias("starts"),
        (F.last("ends").over(file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == 0).alias("closed"))
    lined = known.join(splits, ["file", "block"]).withColumn(
        "ends", (F.coalesce("fixed", "starts") + F.col("swaps")) % 2)
    lined = lined.withColumn("begins", F.coalesce(F.lag("ends").over(split), "starts") == 0)
    whole = F.col("begins") & (F.col("ends") == 0)
    parts = lined.withColumn("first", F.last(F.when(F.col("begins"), F.col("pos")), True).over(here))
    # Lines at the head of a split may belong to a record of an earlier one.
    opened = parts.groupBy("file", "block").agg(F.max("first").alias("last")).select(
        F.col("file"), F.col("block"),
        F.last(F.when(F.col("last").isNotNull(), F.struct("block", "last")), True).over(before).alias("open"))
    parts = parts.filter(~whole).join(opened, ["file", "block"]).select(
        "file", F.when(F.col("first").isNull(), F.col("open.block")).otherwise(F.col("block")).alias("of_block"),
        F.coalesce("first", "open.last").alias("of_pos"), "block", "pos", "value", "closed")
    glued = parts.groupBy("file", "of_block", "of_pos").agg(
        F.array_sort(F.collect_list(F.struct("block", "pos", "value"))).alias("lines"), F.first("closed").alias("closed"))
    glued = glued.select("file", F.col("of_block").alias("block"), F.col("of_pos").alias("pos"),
                         F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record"), "closed")
    alone = lined.filter(whole & ~is_blank(F.col("value"))).select(
        "file", "block", "pos", F.col("value").alias("record"), "closed")
    return alone.unionByName(glued).withColumn("record", _without_return(F.col("record")))
