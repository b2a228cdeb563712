"""Tables that are replaced whole, atomically (SNK3, SNK7, SNK11).

A table is a folder of versions: every run writes its rows to a folder of its
own under ``data/`` and then switches the table to it.  The switch is one rename
of a small file into ``current/`` under the next number, which fails where that
number exists already; the highest number is the table's state.  So

* a table can be rebuilt from itself: a run reads the old version's folder and
  writes another;
* a run that fails before the switch leaves the old version as it was, and its
  folder is only garbage (``vacuum``);
* of two runs at once one fails instead of losing the other's rows;
* readers that started before a switch keep their files until ``vacuum``.

The switch needs a file system whose rename is atomic and refuses an existing
target (HDFS, local disks, mounted shares).  On an object store without such a
rename, use its own commit service or a single writer.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class ConcurrentRun(RuntimeError):
    """Another run switched the table first."""


class TableExists(RuntimeError):
    """The table was created before."""


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(conf)
        # FileContext's rename refuses an existing target
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), conf)

    def _names(self, folder: str) -> list[str]:
        where = self._path(f"{self.root}/{folder}")
        if not self._fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where))

    def versions(self) -> list[tuple[int, str]]:
        """(number, folder) of all switches made, oldest first."""
        return [(int(n), self._text(f"current/{n}")) for n in self._names("current") if not n.startswith((".", "_"))]

    def _text(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def current(self) -> tuple[int, str] | None:
        """Number and folder of the table's state; None before the first run."""
        return (self.versions() or [None])[-1]

    def read(self, number: int | None = None, schema=None) -> DataFrame | None:
        """The table (or an older version that was not vacuumed yet), by its
        declared ``schema`` if given; None before the first run."""
        state = self.current() if number is None else dict(self.versions()).get(number)
        if state is None:
            return None
        folder = state[1] if number is None else state
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.root}/data/{folder}")

    def replace(self, build: Callable[[DataFrame | None], DataFrame], partition_by: str | None = None) -> int:
        """One run: ``build(old)`` gets the table as it is (None at first) and
        returns its new rows.  Returns the new version's number."""
        state = self.current()
        old = self.read()
        folder = uuid.uuid4().hex
        w = build(old).write
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(f"{self.root}/data/{folder}")
        number = state[0] + 1 if state else 1
        self._switch(number, folder)
        return number

    def create(self, rows: DataFrame) -> int:
        """The table's first version; refuses to replace one that is there."""
        if self.current() is not None:
            raise TableExists(self.root)
        return self.replace(lambda old: rows)

    def _switch(self, number: int, folder: str) -> None:
        """Make ``folder`` the table's state, or raise if ``number`` is taken."""
        draft, target = self._path(f"{self.root}/drafts/{folder}"), self._path(f"{self.root}/current/{number:012d}")
        out = self._fs.create(draft)
        out.writeBytes(folder)
        out.close()
        self._fs.mkdirs(target.getParent())
        sc = self.spark.sparkContext
        no_options = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(draft, target, no_options)
        except Exception as e:
            if self._fs.exists(target):
                raise ConcurrentRun(f"{self.root}: version {number} was written by another run") from e
            raise

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete the folders of all but the last ``keep`` versions and of runs
        that never switched; call it when no run is under way."""
        kept = {folder for _, folder in self.versions()[-max(1, keep):]}
        gone = [n for n in self._names("data") if n not in kept]
        for name in gone:
            self._fs.delete(self._path(f"{self.root}/data/{name}"), True)
        for number, _ in self.versions()[:-max(1, keep)]:
            self._fs.delete(self._path(f"{self.root}/current/{number:012d}"), False)
        return gone
