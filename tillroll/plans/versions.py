"""Tables that are replaced by a switch.

A store is a folder.  Each load writes its tables into a new folder of the
store and then commits: one small file ``_versions/<number>.json`` names the
folders that are current from then on.  It appears complete or not at all
(written under another name, then renamed; a number that exists is refused).
Until then, and if a load fails half-way, readers see the version before;
readers that hold a version go on reading its folders.  A commit carries the
load's own id: committing the same id again changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import write_table

KEEP = 2                         # versions whose folders ``clean`` leaves in place


class Store:
    """The versions of the tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _read(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def numbers(self) -> list[int]:
        """Numbers of the committed versions, ascending."""
        where = self._path("_versions")
        if not self._files.exists(where):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(where)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int | None = None) -> dict:
        """``{"number", "commit", "tables": {name: folder or {part: folder}}}``; number 0 before the first commit."""
        number = number if number is not None else max(self.numbers(), default=0)
        if not number:
            return {"number": 0, "commit": None, "tables": {}}
        return json.loads(self._read(f"_versions/{number:012d}.json"))

    def new_folder(self, name: str) -> str:
        """A fresh folder of the store to write a table's next version to."""
        return f"{self.folder}/{name}/v-{uuid.uuid4().hex[:12]}"

    def commit(self, tables: dict, commit: str | None = None) -> dict:
        """Make ``tables`` (name -> folder) current, others stay; a commit that is current already is not repeated."""
        now = self.version()
        if commit is not None and now["commit"] == commit:
            return now
        then = {"number": now["number"] + 1, "commit": commit, "tables": {**now["tables"], **tables}}
        self._files.mkdirs(self._path("_versions"))
        draft, final = self._path(f"_versions/.{uuid.uuid4().hex}"), self._path(f"_versions/{then['number']:012d}.json")
        stream = self._files.create(draft, False)
        stream.write(bytearray(json.dumps(then).encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        gateway = self.spark.sparkContext._gateway
        no_option = gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(self._files.makeQualified(draft), self._files.makeQualified(final), no_option)
        return then

    def names(self, folder: str) -> list[str]:
        """Names in a folder of the store."""
        return [s.getPath().getName() for s in self._files.listStatus(self._jvm.org.apache.hadoop.fs.Path(folder))]

    def read(self, table: str, number: int | None = None) -> DataFrame:
        """A table as of a version, the current one by default."""
        folder = self.version(number)["tables"][table]
        return self.spark.read.parquet(*(sorted(folder.values()) if isinstance(folder, dict) else [folder]))

    def replace(self, table: str, df: DataFrame, commit: str | None = None) -> str:
        """Write ``df`` as the table's next version and switch to it; its folder."""
        folder = self.new_folder(table)
        write_table(df, folder)
        self.commit({table: folder}, commit)
        return folder

    def clean(self, keep: int = KEEP) -> None:
        """Delete folders that none of the last ``keep`` versions names, and older versions."""
        numbers = self.numbers()
        held = set()
        tables = set()
        for n in numbers[-keep:]:
            for name, folder in self.version(n)["tables"].items():
                tables.add(name)
                held.update(f[len(self.folder) + 1:].split("/")[1] for f in (folder.values() if isinstance(folder, dict) else [folder]))
        for name in tables:
            for part in set(self.names(f"{self.folder}/{name}")) - held:
                self._files.delete(self._path(f"{name}/{part}"), True)
        for n in numbers[:-keep]:
            self._files.delete(self._path(f"_versions/{n:012d}.json"), False)
