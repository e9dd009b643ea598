"""Where the tables live: plain Parquet folders below one root.

Bronze, silver and gold tables are laid out by key hash with a log of what is
committed (see ``keyed``). Two simpler layouts serve the rest: rows set aside
stand in one ``load_id=`` folder per load, and small tables that are replaced
as a whole, such as the watermarks, in ``v=`` folders of which the newest
committed one counts. A write that dies half-way leaves readers on what was
committed before it. Each table has one writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import empty_frame

if TYPE_CHECKING:
    from stratalake.keyed import KeyedTable

DEFAULT_SCHEMA = "SILVER"
COMMIT_MARK = "_COMMITTED"

#: Rows of a staged file. Spark deals files out by size, and small ones at a fixed least size each, so a
#: task gets a bounded number of rows however well they are compressed.
STAGED_ROWS = 50_000

#: Hash buckets of a new table; ``KeyedTable.compact`` deals a grown one into more.
BUCKETS = 16


def schema_name(layer: str | None) -> str:
    """A layer's schema name: trimmed and upper-cased, or the default."""
    return DEFAULT_SCHEMA if layer is None else layer.strip().upper()


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str
    buckets: int = BUCKETS  # of tables not written yet

    def path(self, layer: str | None, name: str) -> str:
        return f"{self.root.rstrip('/')}/{schema_name(layer)}/{name}"

    # -- files ---------------------------------------------------------------

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def remove(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def children(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def create_text(self, path: str, text: str) -> None:
        """A small file; fails if it is there already."""
        fs, p = self._fs(path)
        out = fs.create(p, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        fs, p = self._fs(path)
        source = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    # -- rows set aside ------------------------------------------------------

    def append_load(self, layer: str, name: str, df: DataFrame, load_id: str, replace: bool = False) -> int:
        """Add rows to a load's folder, or ``replace`` what is there; returns how many were added."""
        path = f"{self.path(layer, name)}/load_id={load_id}"
        stored = self.spark.read.schema(df.schema)
        before = stored.parquet(path).count() if not replace and self.exists(path) else 0
        df.write.mode("overwrite" if replace else "append").parquet(path)
        return stored.parquet(path).count() - before

    def read_loads(self, layer: str, name: str, schema: T.StructType, but: str | None = None) -> DataFrame:
        """All loads of a table, or all but the one named ``but``."""
        path = self.path(layer, name)
        if not self.exists(path):
            return empty_frame(self.spark, schema)
        full = T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])
        loads = self.spark.read.schema(full).parquet(path)
        if but is not None:
            loads = loads.where(F.col("load_id") != but)
        return loads.drop("load_id")

    # -- replaced tables -----------------------------------------------------

    def _versions(self, path: str) -> tuple[list[int], list[int]]:
        """Numbers of all version folders, and of the committed ones."""
        found = sorted(int(n[2:]) for n in self.children(path) if n.startswith("v="))
        return found, [v for v in found if self.exists(f"{path}/v={v}/{COMMIT_MARK}")]

    def current(self, layer: str | None, name: str) -> str | None:
        """Folder of the committed version in force."""
        path = self.path(layer, name)
        committed = self._versions(path)[1]
        return f"{path}/v={committed[-1]}" if committed else None

    def replace(self, layer: str | None, name: str, df: DataFrame, keep: int = 2) -> str:
        """Write a new version, put it in force, and drop all but the newest ``keep``.

        ``df`` may read the version it replaces. The older version is kept for
        readers that are still on it.
        """
        path = self.path(layer, name)
        found, _ = self._versions(path)
        new = f"{path}/v={found[-1] + 1 if found else 1}"
        df.write.mode("overwrite").parquet(new)
        fs, mark = self._fs(f"{new}/{COMMIT_MARK}")
        fs.create(mark, True).close()
        found, committed = self._versions(path)
        for version in found:
            if version < committed[-1] and version not in committed[-keep:]:
                self.remove(f"{path}/v={version}")
        return new

    def keyed(self, layer: str, name: str, key: str = "", schema: T.StructType | None = None) -> KeyedTable:
        """A table laid out by key hash; readers need not know the key."""
        from stratalake.keyed import KeyedTable

        return KeyedTable(self, layer, name, key, schema)

    def read(self, layer: str | None, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The committed rows of a table of either kind."""
        if self.exists(f"{self.path(layer, name)}/_log"):
            return self.keyed(layer, name, schema=schema).read()
        version = self.current(layer, name)
        if version is None:
            if schema is None:
                raise FileNotFoundError(f"no committed version of {self.path(layer, name)}")
            return empty_frame(self.spark, schema)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(version)

    # -- staging -------------------------------------------------------------

    def stage(self, name: str, df: DataFrame, load_id: str, *metrics: Column) -> tuple[str, DataFrame, dict]:
        """Write a batch once and read it back, with the ``metrics`` asked for.

        The source is read a single time, later steps see the same rows even if
        tasks are run again, and Spark knows the batch's size when it plans the
        merge. Files have a limited number of rows, which bounds what a task that sorts them holds. Metrics are aggregates that the writing tasks take along the way.
        """
        path, seen = f"{self.path('staging', name)}/{load_id}", Observation()
        counted = df.observe(seen, *metrics) if metrics else df
        counted.write.mode("overwrite").option("maxRecordsPerFile", STAGED_ROWS).option("compression", "zstd").parquet(path)
        return path, self.spark.read.schema(df.schema).parquet(path), seen.get if metrics else {}
