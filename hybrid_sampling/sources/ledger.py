"""A table that grows by published parts, each published whole or not at all.

A part is written beside the others first, then named by the next numbered entry of
the ledger. An entry is renamed to its number, which only one run can do: of two runs that
both saw the same last entry, one publishes and the other has to look again. Parts
that no entry names (a run was lost before it published) are never read.

The shared file system must rename without overwriting in one step (HDFS does; object stores
need a committer of theirs).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Ledger:
    """``root``/parts holds the parts, ``root``/entries one small file an entry (one a run that published)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        conf = spark._jsc.hadoopConfiguration()
        self._files = self._path("entries").getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), conf)
        self._no_overwrite = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def version(self) -> int:
        """The number of the last entry, 0 before the first."""
        if not self._files.exists(self._path("entries")):
            return 0
        names = [s.getPath().getName() for s in self._files.listStatus(self._path("entries"))]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _entry(self, number: int) -> str:
        stream = self._files.open(self._path(f"entries/{number:010d}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def read(self, version: int | None = None, last_only: bool = False) -> DataFrame | None:
        """All parts up to ``version`` (default: the last entry), or that entry's part; None where there is none."""
        last = self.version() if version is None else version
        parts = [f"{self.root}/parts/{self._entry(k)}" for k in range(max(last, 1) if last_only else 1, last + 1)]
        return self.spark.read.parquet(*parts) if parts else None

    def publish(self, part: DataFrame, seen: int, run_id: str) -> bool:
        """Write ``part`` and name it by the entry after ``seen``; False if another run published that entry first."""
        name = f"{run_id}-{uuid.uuid4().hex[:8]}"
        part.write.mode("errorifexists").parquet(f"{self.root}/parts/{name}")
        draft = self._path(f"entries/.draft-{name}")
        out = self._files.create(draft, False)
        try:
            out.write(bytearray(name.encode()))
        finally:
            out.close()
        try:
            self._context.rename(draft, self._path(f"entries/{seen + 1:010d}"), self._no_overwrite)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            self._files.delete(draft, False)
            return False
        return True

    def append(self, make: Callable[[DataFrame | None], DataFrame], run_id: str, last_only: bool = False) -> DataFrame | None:
        """Publish ``make(what is published)``, made anew each time another run was first. None where it has no rows.

        Rows are read back from the part, so what is returned is what was published."""
        while True:
            seen = self.version()
            part = make(self.read(seen, last_only))
            if part.isEmpty():
                return None
            if self.publish(part, seen, run_id):
                return self.read(seen + 1, last_only=True)
