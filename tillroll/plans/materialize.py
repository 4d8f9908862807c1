"""Load once, query many: a drop's tables, stored when first used.

The original loader stored the rows of a folder of CSV files once and every
question read that table.  A ``StoredDrop`` keeps three parquet tables under
fixed names in one folder, each written when a query first needs it and then
read by all:

* ``sales``   - raw rows with their ``row_seq`` identity, sorted by
                (order_date, row_seq) inside files, so date filters prune;
* ``firsts``  - the first copies that the two cleaning orders need, flat, one
                row each; the view and the EDA set are filters over it;
* ``targets`` - one row per salesperson.

The written tables also cut lineage: a lost executor costs a re-read.

``load`` stores what the driver's star tables give, ``load_drop`` a folder of
CSV files.  A ``load_drop`` writes all three tables to a new folder and then
switches to it in one commit (``versions.py``); ``open_drop`` reads the current
version.  Loads of the star tables are kept per session and fingerprint of
every input file (path, length, modification time from the Hadoop listing),
so changed inputs are loaded again.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import clean as C
from tillroll.operators.questions import targets_dim
from tillroll.plans.summaries import Summaries
from tillroll.plans.versions import Store
from tillroll.schema import FIXTURE_PARAMS, RAW_SCHEMA, ROW_SEQ, Params
from tillroll.session import scratch_path, write_table
from tillroll.sources.daily_csv import read_daily_drop
from tillroll.sources.sinks import by_day, clustered
from tillroll.sources.tables import Deal, raw_first_copies, raw_sales, table_path
from tillroll.workspace import Drop

_LOADS: dict[tuple, Drop] = {}
_LOCK = threading.RLock()
_TABLES = ["lineitem", "orders", "customer", "nation", "region", "supplier", "part"]


class StoredDrop(Drop):
    """A drop whose raw rows, first copies and targets are tables in ``store``.

    While no query has needed the raw rows, first copies and targets are made
    from the source: ``first_source`` gives its first copies, if it has a way.
    """

    def __init__(self, spark: SparkSession, source: Callable[[], DataFrame], store: str, params: Params = Params(),
                 first_source: Callable[[], DataFrame] | None = None, dealt_source: Callable[[Deal], DataFrame] | None = None):
        super().__init__(spark, None, params)
        del self.__dict__["raw"]
        self.source = source
        self.first_source = first_source
        self.dealt_source = dealt_source
        self.store = store.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.store}/{name}")

    @cached_property
    def raw(self) -> DataFrame:
        with _LOCK:
            write_table(clustered(self.dealt(by_day), dealt=True), f"{self.store}/sales", "overwrite")
            return self._read("sales")

    @cached_property
    def firsts(self) -> DataFrame:
        with _LOCK:
            stored = "raw" in self.__dict__ or self.first_source is None
            firsts = C.first_copies(self.raw) if stored else self.first_source()
            write_table(firsts, f"{self.store}/firsts", "overwrite")
            return self._read("firsts")

    @property
    def rows(self) -> DataFrame:
        """The raw rows for one pass: the stored table if there is one, else straight from the star tables."""
        return self.raw if "raw" in self.__dict__ or self.first_source is None else self.source()

    def dealt(self, deal: Deal) -> DataFrame:
        """The raw rows dealt to tasks by ``deal``; straight from the star tables, before columns that follow from others are made."""
        if "raw" in self.__dict__:
            return deal(self.raw, [ROW_SEQ])
        return deal(self.source(), [ROW_SEQ]) if self.dealt_source is None else self.dealt_source(deal)

    @cached_property
    def targets(self) -> DataFrame:
        with _LOCK:
            write_table(targets_dim(self.rows, self.params.weekly_target), f"{self.store}/targets", "overwrite")
            return self._read("targets")

    @cached_property
    def visits(self) -> DataFrame:
        """Who was met where, as bitmaps (``summaries.month_visits``)."""
        with _LOCK:
            kept = Summaries(self.spark, f"{self.store}/summaries")
            kept.refresh(self.firsts, tables=("visits",), commit="visits")
            return kept.table("visits")

    @cached_property
    def clean(self) -> DataFrame:
        return C.sales_clean_from_firsts(self.firsts)

    @cached_property
    def dedup(self) -> DataFrame:
        return C.dedup_clean_from_firsts(self.firsts, with_gross=True)

    def store_all(self) -> StoredDrop:
        """Write every table now."""
        self.raw, self.firsts, self.targets
        return self


def fingerprint(spark: SparkSession, paths: list[str]) -> tuple:
    """Path, length and modification time of every file under ``paths``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        files = path.getFileSystem(conf)
        status = files.getFileStatus(path)
        found = [status] if status.isFile() else []
        listing = files.listFiles(path, True) if status.isDirectory() else None
        while listing is not None and listing.hasNext():
            found.append(listing.next())
        out += [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found]
    return tuple(sorted(out))


def load(spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS) -> StoredDrop:
    """The drop that the star tables of ``sf_dir`` give, stored in the shared folder."""
    files = fingerprint(spark, [table_path(sf_dir, t) for t in _TABLES])
    key = (spark.sparkContext.applicationId, sf_dir, files, params)
    with _LOCK:
        if key not in _LOADS:
            _LOADS[key] = StoredDrop(spark, lambda: raw_sales(spark, sf_dir), scratch_path(spark, "load"), params,
                                     lambda: raw_first_copies(spark, sf_dir), lambda deal: raw_sales(spark, sf_dir, deal))
        return _LOADS[key]


def load_drop(spark: SparkSession, csv_path: str, store: str, params: Params = Params(),
              schema=RAW_SCHEMA, commit: str | None = None) -> StoredDrop:
    """A folder of CSV files as the tables sales, firsts and targets of ``store``.

    The tables that a load before has written stay readable until all three
    new ones are written, and for those that hold them afterwards.  The
    ledger of the files is kept in the store.  A ``commit`` that is current
    already is not loaded again.
    """
    versions = Store(spark, store)
    now = versions.version()
    if commit is None or now["commit"] != commit:
        folder = versions.new_folder("load")
        StoredDrop(spark, lambda: read_daily_drop(spark, csv_path, schema, ledger=f"{versions.folder}/ledger"),
                   folder, params).store_all()
        versions.commit({"load": folder}, commit)
    return open_drop(spark, store, params)


def open_drop(spark: SparkSession, store: str, params: Params = Params(), number: int | None = None) -> StoredDrop:
    """The drop that ``load_drop`` stored, as of a version, the current one by default."""
    drop = StoredDrop(spark, None, Store(spark, store).version(number)["tables"]["load"], params)
    drop.__dict__.update({name: drop._read("sales" if name == "raw" else name) for name in ("raw", "firsts", "targets")})
    return drop
