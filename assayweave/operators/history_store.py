"""Type-2 history in files: every version writes what it changes, closed windows are never written again.

    <path>/changes/load=<n>/_change=opened|closed/…    windows opened and windows closed by version n
    <path>/open/base=<n>/…                             open windows at version n, from a compaction
    <path>/versions/v<n>/…                             one row: the base and the loads a reader needs

A version is its row with the success marker. It is written last, so a run that broke off before leaves files no
version names; they are replaced when the number is taken again. Open windows are those opened since the base and not
closed since; the closed ones are read as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .history import scd2_changes
from .keyed import finished_versions

_VERSION = "base bigint, loads array<bigint>, schema string"


class HistoryStore:
    """The windows of a key's attributes; see the module. A change in ``check_cols`` opens a new window."""

    def __init__(self, spark: SparkSession, path: str, key: str, check_cols: Sequence[str]):
        self.spark, self.path, self.key, self.check_cols = spark, path.rstrip("/"), key, list(check_cols)

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        return sorted(v for v, done in self._tried().items() if done)

    def _tried(self) -> dict[int, bool]:
        return finished_versions(self.spark, f"{self.path}/versions")

    def _version(self, version: int | None):
        known = self.versions()
        if version is None and not known:
            return None
        if version is not None and version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        number = known[-1] if version is None else version
        return self.spark.read.schema(_VERSION).parquet(f"{self.path}/versions/v{number}").first()

    def _loads(self, change: str, loads: Sequence[int], schema: str) -> DataFrame | None:
        """Rows of one kind of the given loads; their folders are named, so no other load is listed or read."""
        if not loads:
            return None
        folders = [f"{self.path}/changes/load={n}/_change={change}" for n in loads]
        present = [f for f in folders if self._exists(f)]  # a load without such changes has no folder
        return self.spark.read.schema(schema).parquet(*present) if present else None

    def _exists(self, folder: str) -> bool:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(context._jsc.hadoopConfiguration()).exists(path)

    def open_windows(self, version: int | None = None) -> DataFrame | None:
        """The open windows of a version, by default the last. None before the first version."""
        at = self._version(version)
        if at is None:
            return None
        since = [n for n in at.loads if n > at.base]
        parts = [self.spark.read.schema(at.schema).parquet(f"{self.path}/open/base={at.base}")] if at.base else []
        parts += [p for p in [self._loads("opened", since, at.schema)] if p is not None]
        if not parts:
            return self.spark.createDataFrame([], at.schema)
        opened = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        closed = self._loads("closed", since, at.schema)
        return opened if closed is None else opened.join(closed.select("window_id"), "window_id", "left_anti").select(*opened.columns)

    def read(self, version: int | None = None) -> DataFrame | None:
        """All windows of a version: closed ones as written, and the open ones."""
        at = self._version(version)
        if at is None:
            return None
        opened, closed = self.open_windows(version), self._loads("closed", at.loads, at.schema)
        return opened if closed is None else closed.unionByName(opened)

    def apply(self, current: DataFrame, now: Column) -> int:
        """Write the next version for the current rows and return its number.

        ``current`` has one row for each key. Written are the changes and a row for the version, whatever the size of
        the history. NULL keys cannot be told apart from each other and are left out.
        """
        before = self._version(None)
        rows = current.where(F.col(self.key).isNotNull())
        opened = self.open_windows() if before else None
        if opened is None:
            types = {"valid_from": "timestamp", "valid_to": "timestamp", "window_id": "string"}
            opened = rows.limit(0).withColumns({c: F.lit(None).cast(t) for c, t in types.items()})
        number = max(self._tried(), default=0) + 1
        changes = scd2_changes(opened, rows, self.key, self.check_cols, now)
        schema = changes.drop("_change").schema
        changes.write.partitionBy("_change").mode("overwrite").parquet(f"{self.path}/changes/load={number}")
        loads = [*(before.loads if before else []), number]
        self._commit(number, before.base if before else 0, loads, _ddl(schema))
        return number

    def compact(self) -> int | None:
        """Write the open windows of the last version together, so that readers need no earlier openings; a new version.

        Closed windows stay where they are.
        """
        at = self._version(None)
        if at is None:
            return None
        number = max(self._tried(), default=0) + 1
        self.open_windows().write.mode("overwrite").parquet(f"{self.path}/open/base={number}")
        self._commit(number, number, at.loads, at.schema)
        return number

    def _commit(self, number: int, base: int, loads: list[int], schema: str) -> None:
        row = self.spark.createDataFrame([(base, loads, schema)], _VERSION)
        row.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/versions/v{number}")

    def expire(self, keep: int = 2) -> list[int]:
        """Delete the ``keep`` newest versions' predecessors and what only they name; returns their numbers.

        The changes of a load are named by every later version, so openings go when a compaction has replaced them.
        """
        known = self.versions()
        kept = known[-keep:]
        if not kept:
            return []
        first = min((self._version(v).base for v in kept), default=0)
        old = [v for v in self._tried() if v < kept[0]]
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path

        def delete(folder: str) -> None:
            p = path(folder)
            p.getFileSystem(context._jsc.hadoopConfiguration()).delete(p, True)

        for v in old:
            delete(f"{self.path}/versions/v{v}")
            if v < first:
                delete(f"{self.path}/open/base={v}")
                delete(f"{self.path}/changes/load={v}/_change=opened")
        return sorted(old)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
