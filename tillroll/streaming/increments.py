"""Ingest daily CSV drops incrementally (``trigger(availableNow=True)``).

The stream is a stream of file names: its source lists new files and opens
none.  Each micro-batch reads its files' lines once and stores them; headers,
records of several lines and the raw rows come from the stored lines
(``daily_csv.rows_of_lines``), so columns are aligned by name and records are
those of batch jobs.  The rows are appended to a raw parquet table, a folder
``batch=<epoch>`` in overwrite mode: a batch replayed after a failure replaces
its own output.

Every row keeps its ``row_seq`` identity (file path, split start, position).
With ``firsts`` the first copies of all order_ids are kept up to date by a
merge of each batch (``firsts.py``), which the row's identity decides, not
the order of arrival; reading them deduplicates nothing.  An in-stream
``dropDuplicates`` would keep whichever copy a task saw first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.plans.summaries import Summaries
from tillroll.schema import RAW_SCHEMA, ROW_SEQ
from tillroll.session import remove_scratch, scratch_path, write_table
from tillroll.sources.daily_csv import rows_of_lines, stored_lines
from tillroll.sources.ledger import CSV_FILES, Ledger, named, readable
from tillroll.streaming.firsts import FirstCopies

BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, drop_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming file, length, modified of a drop folder's CSV files; no content is read."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", CSV_FILES) \
        .option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return named(reader.load(drop_dir))


def _append_batch(table_dir: str, schema: T.StructType, checkpoint: str, firsts: FirstCopies | None, ledger: str | None,
                  summaries: Summaries | None):
    def write(batch: DataFrame, epoch_id: int) -> None:
        found = batch.collect()                              # names of this batch's files
        files = [readable(r.file) for r in found if r.length]
        if not files:
            return
        spark, keep = batch.sparkSession, scratch_path(batch.sparkSession, "lines")
        folder = f"{table_dir}/batch={epoch_id:010d}"
        write_table(rows_of_lines(stored_lines(spark, files, keep), schema), folder, "overwrite")
        remove_scratch(spark, keep)
        rows = spark.read.parquet(folder)
        if firsts is not None:
            changed = firsts.merge(rows, f"{checkpoint}#{epoch_id}")
            if summaries is not None and changed.days:
                summaries.refresh(firsts.read(), changed.days, f"{checkpoint}#{epoch_id}")
        if ledger is not None:
            ranges = rows.groupBy(F.col(f"{ROW_SEQ}.file").alias("file")).agg(
                F.count(F.lit(1)).alias("rows"), F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))
            Ledger(spark, ledger).add_ranges(spark.createDataFrame(found, batch.schema).join(ranges, "file", "left")
                                             .fillna(0, "rows"))
    return write


def ingest_available(spark: SparkSession, drop_dir: str, table_dir: str, checkpoint_dir: str,
                     schema: T.StructType = RAW_SCHEMA, files_per_batch: int | None = None,
                     firsts: FirstCopies | None = None, ledger: str | None = None,
                     summaries: Summaries | None = None) -> StreamingQuery:
    """Append every not-yet-ingested file of ``drop_dir`` to ``table_dir``, then stop.

    ``firsts`` also gets every batch, ``summaries`` the days whose first copies
    a batch changed, and ``ledger`` (a folder) the rows and dates of every file.
    """
    stream = new_files(spark, drop_dir, files_per_batch)
    return (stream.writeStream.foreachBatch(_append_batch(
        table_dir, schema, checkpoint_dir, firsts, ledger, summaries))
                  .option("checkpointLocation", checkpoint_dir)
                  .trigger(availableNow=True)
                  .start())


def read_ingested(spark: SparkSession, table_dir: str) -> DataFrame:
    """All ingested rows (every batch folder), without the batch column."""
    return spark.read.parquet(table_dir).drop("batch")
