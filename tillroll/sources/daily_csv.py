"""Order drops: CSV files with a header row, one or several days per file.

``read_daily_drop`` scans every file of a drop with a fixed schema (no
inference pass) and attaches the hidden ``row_seq`` identity column:

    (file path, start of the file split, position in the split, faults)

The position grows within one split and the split start orders the splits of
a file, so sorting by ``row_seq`` reproduces "files in sorted name order,
rows in file order" without a global row number.

Which files there are, their headers and whether quoted fields go over
several lines stands in a ledger (``ledger.py``), filled once per file by
tasks.  Plain files go through Spark's CSV scan; files with multi-line
fields are read line by line and put together (``lines.py``), in parallel too.
The dialect is that of Python's csv module and pandas: a quote within quotes
is doubled, a backslash is a character like any other.  A file that ends
inside quotes is an error, as it is there.

Columns are aligned by header name: columns that a header lacks are NULL,
columns that the schema lacks are left out.  Headers of any number of forms
take one scan: fields are read by position and picked by the file's header.

Everything is read as text and converted here.  Text that pandas reads as
missing (``schema.NULL_TOKENS``) is NULL.  A whole number may be written with
a zero fraction (``12.0``, as pandas does for a column with a blank).  Text
that does not convert is NULL too, and ``row_seq.faults`` names the column
and the text; ``quality.unparsed_report`` counts them.
"""

from __future__ import annotations

import datetime
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schema import DROP_MONTH, NULL_TOKENS, RAW_SCHEMA, ROW_SEQ
from tillroll.session import scratch_path, stable_path, write_table
from tillroll.sources.ledger import CSV_FILES, Ledger, columns_of, is_glob, listing, readable
from tillroll.sources.lines import DIALECT, end_states, is_blank, joined_lines, read_lines, whole_lines


def _missing(value: Column) -> Column:
    return F.when(value.isin(NULL_TOKENS), F.lit(None)).otherwise(value)


def _converted(value: Column, kind: T.DataType) -> Column:
    """``value`` (text without missing tokens) as ``kind``; NULL if it does not convert exactly."""
    if isinstance(kind, T.StringType):
        return value
    text = F.trim(value)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        whole = F.regexp_extract(text, r"^([+-]?\d+)(\.0*)?$", 1)
        return whole.try_cast(kind)
    return text.try_cast(kind)


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns ``t.<name>`` and file, block, pos as the schema's columns with the row's identity and faults."""
    text = {f.name: _missing(F.col(f"t.`{f.name}`")) for f in schema.fields}
    values = {f.name: _converted(text[f.name], f.dataType) for f in schema.fields}
    faults = [F.when(text[f.name].isNotNull() & values[f.name].isNull(), F.concat(F.lit(f"{f.name}="), text[f.name]))
              for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    seq = F.struct("file", "block", "pos", F.array_compact(F.array(*faults)).alias("faults"))
    return df.select(*[values[f.name].alias(f.name) for f in schema.fields], seq.alias(ROW_SEQ))


def _positions(header: tuple[str, ...], schema: T.StructType) -> list[int | None]:
    return [header.index(n) if n in header else None for n in schema.names]


def _picked(fields: DataFrame, width: int, forms: dict[str | None, list[str]], schema: T.StructType) -> DataFrame:
    """file, block, pos, p0 ... -> with ``t``: the text of every column of the schema, picked by header.

    ``forms``: header -> files.  With one header the columns are named
    outright, so that the scan prunes them; with several, rows meet their file's.
    """
    at = {header: _positions(columns_of(header), schema) for header in forms}
    if len(at) == 1:
        places = next(iter(at.values()))
        text = [F.lit(None).cast("string") if p is None else F.col(f"p{p}") for p in places]
        return fields.select("file", "block", "pos", F.struct(*[c.alias(n) for c, n in zip(text, schema.names)]).alias("t"))
    of_file = fields.sparkSession.createDataFrame(
        [(f, [None if p is None else p + 1 for p in at[header]]) for header, files in forms.items() for f in files],
        "file string, places array<int>")
    every = F.array(*[F.col(f"p{k}") for k in range(width)])
    text = [F.when(F.col("places")[k].isNotNull(), F.element_at(every, F.coalesce(F.col("places")[k], F.lit(1)))).alias(n)
            for k, n in enumerate(schema.names)]
    return fields.join(F.broadcast(of_file), "file").select("file", "block", "pos", F.struct(*text).alias("t"))


def _width(forms: dict[str | None, list[str]]) -> int:
    return max([1, *(len(columns_of(h)) for h in forms)])


def _field_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"p{k}", T.StringType()) for k in range(width)])


def _plain_rows(spark: SparkSession, path, forms: dict[str | None, list[str]], schema: T.StructType) -> DataFrame:
    """Rows of files whose records are lines, by Spark's CSV scan."""
    width = _width(forms)
    scan = spark.read.schema(_field_schema(width)).options(**DIALECT).option("header", True) \
        .option("enforceSchema", True).option("pathGlobFilter", CSV_FILES) \
        .option("recursiveFileLookup", not is_glob(path)).csv(path)
    meta = F.col("_metadata")
    fields = scan.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
                         F.monotonically_increasing_id().alias("pos"), *[f"p{k}" for k in range(width)])
    return _typed(_picked(fields, width, forms, schema), schema)


def rows_of_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of files of any kind from their stored lines (``read_lines`` with ``end_states``).

    The first record of a file is its header.  Which files hold records of
    several lines is one small aggregate; only those go through windows.
    """
    spark = lines.sparkSession
    kinds = lines.groupBy("file", "block").agg(F.max("out_end").alias("open"), F.min(
        F.when(~is_blank(F.col("value")), F.col("pos"))).alias("first")).collect()       # a row per split
    several = sorted({r.file for r in kinds if r.open})
    firsts = [r for r in kinds if r.file not in several]
    records = whole_lines(lines.filter(~F.col("file").isin(several)) if several else lines)
    if several:
        path = scratch_path(spark, "records")
        joined_lines(lines.filter(F.col("file").isin(several))).write.parquet(path)
        glued = spark.read.parquet(path)
        unclosed = [r.file for r in glued.filter(~F.col("closed")).select("file").distinct().limit(5).collect()]
        if unclosed:
            raise ValueError(f"a quoted field is never closed in {', '.join(unclosed)}")
        firsts += glued.groupBy("file", "block").agg(F.min("pos").alias("first")).collect()
        records = records.unionByName(glued.drop("closed"))
    first: dict[str, tuple[int, int]] = {}
    for r in firsts:
        if r.first is not None:
            first[r.file] = min(first.get(r.file, (r.block, r.first)), (r.block, r.first))
    if not first:
        return no_rows(spark, schema)
    places = spark.createDataFrame([(f, *p) for f, p in first.items()], "file string, first_block long, first_pos long")
    placed = records.join(F.broadcast(places), "file")                                   # a row per file: lines stay where they are
    is_header = (F.col("block") == F.col("first_block")) & (F.col("pos") == F.col("first_pos"))
    forms: dict[str | None, list[str]] = {}
    for r in placed.filter(is_header).select("file", "record").collect():                # a row per file
        forms.setdefault(r.record, []).append(r.file)
    data = placed.filter(~is_header).select("file", "block", "pos", "record")
    width = _width(forms)
    fields = data.withColumn("p", F.from_csv("record", _field_schema(width).simpleString()[7:-1].replace(":", " "), DIALECT)) \
        .select("file", "block", "pos", "p.*")
    return _typed(_picked(fields, width, forms, schema), schema)


def stored_lines(spark: SparkSession, files: list[str], keep: str) -> DataFrame:
    """The lines of files, read once and stored with their end states at ``keep``."""
    write_table(end_states(read_lines(spark, files)), keep, "overwrite")
    return spark.read.parquet(keep)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    text = T.StructType([T.StructField(n, T.StringType()) for n in schema.names])
    return _typed(spark.createDataFrame([], T.StructType([
        T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("pos", T.LongType()),
        T.StructField("t", text)])), schema)


def _ledger_folder(spark: SparkSession, path: str | list[str]) -> str:
    return stable_path(spark, "ledger-" + hashlib.sha256(repr(path).encode()).hexdigest()[:16])


def _rows(spark: SparkSession, path, files: list, schema: T.StructType, all_listed: bool) -> DataFrame:
    """Rows of ledger entries; ``path`` holds no other files if ``all_listed``."""
    plain: dict[str | None, list[str]] = {}
    for r in files:
        if r.length and not r.multiline:
            plain.setdefault(r.header, []).append(r.file)
    several = [readable(r.file) for r in files if r.multiline]
    parts = []
    if plain:
        whole = all_listed and not several and isinstance(path, str)
        parts.append(_plain_rows(spark, path if whole else [readable(f) for fs in plain.values() for f in fs], plain, schema))
    if several:
        parts.append(rows_of_lines(stored_lines(spark, several, scratch_path(spark, "lines")), schema))
    if not parts:
        return no_rows(spark, schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_daily_drop(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_SCHEMA,
                    days: tuple[datetime.date, datetime.date] | None = None, ledger: str | None = None) -> DataFrame:
    """All CSV files under ``path`` (a folder, a glob or a list) as raw rows.

    ``days`` (first, last) limits the read to rows of these days, and opens
    only files that hold some, by the ledger.  ``ledger`` is its folder, kept
    from run to run; without it the application keeps one of its own.  An
    empty folder gives no rows.
    """
    book = Ledger(spark, ledger or _ledger_folder(spark, path))
    listed = listing(spark, path)
    if days is not None:         # a written drop names months in its folders
        month = F.regexp_extract("file", rf"/{DROP_MONTH}=(\d{{4}}-\d{{2}})/", 1)
        listed = listed.filter((month == "") | month.between(*[d.strftime("%Y-%m") for d in days]))
    found = book.record_files(listed, schema.names)
    if days is None:
        return _rows(spark, path, found.collect(), schema, all_listed=True)

    def dates(files: list[str]) -> DataFrame:
        some = found.filter(F.col("file").isin(files)).collect()
        return _rows(spark, path, some, schema, all_listed=False).select(F.col(f"{ROW_SEQ}.file").alias("file"), "order_date")
    ranged = book.record_ranges(found, dates)
    some = ranged.filter((F.col("first_date") <= F.lit(days[1])) & (F.col("last_date") >= F.lit(days[0]))).collect()
    return _rows(spark, path, some, schema, all_listed=False).filter(F.col("order_date").between(*days))


def source_files(spark: SparkSession, path: str | list[str]) -> int:
    """Number of files of a drop, files without rows included."""
    return listing(spark, path).count()
