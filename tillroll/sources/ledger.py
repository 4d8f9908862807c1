"""A ledger of the files of a drop: what each one is, found out once.

``files`` has one row per (path, length, time of change): the header line and
whether a quoted field goes over several lines.  ``ranges`` has the rows and
the first and last order_date of a file.  Both are filled by tasks, for files
that they do not hold yet, and only ever appended to; a changed file has
another length or time, so its old row no longer applies.

The listing reads names, lengths and times alone.
"""

from __future__ import annotations

import csv
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.lines import end_states, read_lines

KEY = ["file", "length", "modified"]
FILES = "file string, length long, modified timestamp, header string, multiline boolean"
RANGES = "file string, length long, modified timestamp, rows long, first_date date, last_date date"
CSV_FILES = "*.csv*"


def listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, length, modified of every CSV file under ``path``; no content is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", CSV_FILES) \
        .option("recursiveFileLookup", not is_glob(path)).load(path)
    return named(found)


def named(found: DataFrame) -> DataFrame:
    """The listing columns of a (streaming) read of binary files."""
    meta = F.col("_metadata")
    return found.select(meta["file_path"].alias("file"), meta["file_size"].alias("length"),
                        meta["file_modification_time"].alias("modified"))


def is_glob(path: str | list[str]) -> bool:
    """Whether a path is a pattern or a list; a folder is read with all folders below it."""
    return not isinstance(path, str) or bool(re.search(r"[*?\[{]", path))


def readable(file: str) -> str:
    """A listed file's name as a path to read: nothing in it is a pattern."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(file))


def columns_of(header: str | None) -> tuple[str, ...]:
    """Column names of a header record."""
    return tuple(next(csv.reader([header.lstrip("﻿")]), [])) if header else ()


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, empty if it was never written."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _facts(spark: SparkSession, files: list[str], fields: list[str]) -> DataFrame:
    """Header and multiline of files, from one pass over their lines.

    Only lines that hold the name of a column of the schema can be a header
    that matters; just those travel as text.
    """
    names = "|".join(re.escape(n) for n in fields)
    lines = end_states(read_lines(spark, [readable(f) for f in files]))
    opening = F.col("block") == 0
    named = opening & F.col("value").rlike(rf'(^|﻿|,)"?({names})"?\r?(,|$)')
    head = F.array_min(F.collect_list(F.when(named, F.struct("pos", F.rtrim(F.col("value")).alias("line")))))
    return lines.groupBy(*KEY).agg(F.min(F.when(opening, F.col("pos"))).alias("first"), head.alias("head"),
                                   F.max("out_end").alias("open")) \
        .select(*KEY, F.when(F.col("first") == F.col("head.pos"), F.col("head.line")).alias("header"),
                (F.col("open") == 1).alias("multiline"))


class Ledger:
    """The ledger of one drop, stored in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _missing(self, found: DataFrame, table: str, schema: str) -> list[T.Row]:
        """Files that a table does not hold: names, as Spark's own listing keeps them."""
        return found.join(stored(self.spark, f"{self.folder}/{table}", schema), KEY, "left_anti").collect()

    def record_files(self, found: DataFrame, fields: list[str]) -> DataFrame:
        """``found`` with header and multiline; files not met before are looked into first."""
        new = self._missing(found, "files", FILES)
        filled = [r.file for r in new if r.length]
        if filled:
            self._append("files", _facts(self.spark, filled, fields), FILES)
        empty = [r for r in new if not r.length]
        if empty:
            self._append("files", self.spark.createDataFrame([(*r, None, False) for r in empty], FILES), FILES)
        return found.join(stored(self.spark, f"{self.folder}/files", FILES), KEY)

    def record_ranges(self, found: DataFrame, read) -> DataFrame:
        """``found`` with rows, first_date and last_date; ``read(files)`` gives file and order_date of others' rows."""
        new = self._missing(found.select(*KEY), "ranges", RANGES)
        if new:
            counted = read([r.file for r in new]).groupBy("file").agg(
                F.count(F.lit(1)).alias("rows"), F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))
            keys = self.spark.createDataFrame(new, found.select(*KEY).schema)
            self._append("ranges", keys.join(counted, "file", "left").fillna(0, "rows"), RANGES)
        return found.join(stored(self.spark, f"{self.folder}/ranges", RANGES), KEY)

    def add_ranges(self, ranges: DataFrame) -> None:
        """Rows of ``ranges`` that were counted elsewhere, as an ingestion does."""
        self._append("ranges", ranges, RANGES)

    def _append(self, table: str, rows: DataFrame, schema: str) -> None:
        names = T._parse_datatype_string(schema).names
        rows.select(*names).write.mode("append").parquet(f"{self.folder}/{table}")
