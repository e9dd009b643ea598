"""Tables laid out by a hash of their key, with a log of what is committed.

Each write makes a folder of its own with one ``_bucket=`` folder per hash bucket. It
counts once an entry of the log names it: an entry lists the folders, and the buckets of
each, that are in force. So readers see a write whole or not at all, a merge reads the
batch's buckets only, an update replaces the buckets that it touches and leaves the files
of the others, and many small folders are put together without anyone noticing.

A table has one writer at a time. A second one fails when it commits.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.lake import Lake
from stratalake.session import empty_frame

BUCKET, FOLDER = "_bucket", "_folder"
#: Entries of the log that are kept, and those of them whose folders are kept for readers still on them.
ENTRIES, READABLE = 100, 2


@dataclass(frozen=True)
class Part:
    """One write's folder: its loads, which of its buckets are in force, its rows as written, and the folders it stands for."""

    folder: str
    loads: tuple[str, ...]
    buckets: tuple[int, ...]
    whole: bool
    rows: int
    merged: tuple[str, ...] = ()


@dataclass(frozen=True)
class Snapshot:
    """What an entry of the log says. ``built_from`` names the entries of other tables that this one was computed from."""

    number: int
    buckets: int
    rows: int = 0
    schema: str | None = None
    parts: tuple[Part, ...] = ()
    built_from: dict[str, int] = field(default_factory=dict)

    def has_load(self, load_id: str) -> bool:
        return any(load_id in p.loads for p in self.parts)

    def merged_load(self, load_id: str) -> bool:
        """Whether a load's rows are in a folder together with others."""
        return any(load_id in p.loads and len(p.loads) > 1 for p in self.parts)


def _snapshot(text: str) -> Snapshot | None:
    """An entry; None for one whose writer died over it."""
    try:
        raw = json.loads(text)
    except json.JSONDecodeError:
        return None
    parts = tuple(Part(**{k: tuple(v) if isinstance(v, list) else v for k, v in p.items()}) for p in raw.pop("parts"))
    return Snapshot(**raw, parts=parts)


def touched(before: Snapshot, after: Snapshot) -> tuple[list[Part], list[int]]:
    """The parts that came after a snapshot, and all buckets whose rows may differ.

    A compaction of folders known before changes nothing.
    """
    known = {p.folder: p for p in before.parts}
    now = {p.folder for p in after.parts} | {m for p in after.parts for m in p.merged}
    new = [p for p in after.parts if p.folder not in known and not (p.merged and set(p.merged) <= set(known))]
    changed = {b for p in new for b in p.buckets}
    changed |= {b for p in before.parts if p.folder not in now for b in p.buckets}
    for p in after.parts:  # buckets that an update has replaced
        if p.folder in known:
            changed |= set(known[p.folder].buckets) - set(p.buckets)
    return new, sorted(changed)


def fresh_parts(before: Snapshot, after: Snapshot) -> list[Part] | None:
    """The parts that came after a snapshot if they are all that differs and hold none of its rows, as a compaction's may."""
    new, _ = touched(before, after)
    return new if only_added(before, after) and not any(p.merged for p in new) else None


def only_added(before: Snapshot, after: Snapshot) -> bool:
    """Whether all rows of a snapshot are still in force in a later one."""
    now = {p.folder: p for p in after.parts}
    merged = {m for p in after.parts for m in p.merged}
    return all(p.folder in merged or (p.folder in now and now[p.folder].buckets == p.buckets) for p in before.parts)


@dataclass(frozen=True)
class KeyedTable:
    """A table in ``lake`` whose rows are dealt into buckets by ``key``; equal keys, NULLs among them, share a bucket."""

    lake: Lake
    layer: str
    name: str
    key: str
    schema: T.StructType | None = None

    @property
    def path(self) -> str:
        return self.lake.path(self.layer, self.name)

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    # -- the log ---------------------------------------------------------------

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.lake.children(f"{self.path}/_log") if n.endswith(".json") and n[:-5].isdigit())

    def _entry(self, number: int) -> Snapshot | None:
        return _snapshot(self.lake.read_text(f"{self.path}/_log/{number:012d}.json"))

    def _newest(self, count: int) -> list[Snapshot]:
        found: list[Snapshot] = []
        for number in reversed(self._numbers()):
            if len(found) < count and (entry := self._entry(number)):
                found.append(entry)
        return found

    def snapshot(self) -> Snapshot:
        """The newest committed entry; an empty one for a table never written."""
        return next(iter(self._newest(1)), Snapshot(0, self.lake.buckets))

    def snapshot_at(self, number: int) -> Snapshot | None:
        """An older entry, if the log still has it."""
        return self._entry(number) if number in self._numbers() else None

    def readable(self, at: Snapshot) -> bool:
        """Whether the folders of an older entry are still there."""
        there = set(self.lake.children(self.data))
        return all(f"{FOLDER}={p.folder}" in there for p in at.parts)

    def _commit(self, before: Snapshot, **changes) -> None:
        """Put an entry into force, then remove old ones and folders that no reader can be on."""
        newer = [n for n in self._numbers() if n > before.number]
        if any(self._entry(n) for n in newer):
            raise RuntimeError(f"another writer has committed to {self.path}")
        after = replace(before, number=max([before.number, *newer]) + 1, **changes)
        self.lake.create_text(f"{self.path}/_log/{after.number:012d}.json", json.dumps(asdict(after)))
        for number in self._numbers()[:-ENTRIES]:
            self.lake.remove(f"{self.path}/_log/{number:012d}.json")
        needed = {f"{FOLDER}={p.folder}" for e in self._newest(READABLE) for p in e.parts}
        for folder in set(self.lake.children(self.data)) - needed:
            self.lake.remove(f"{self.data}/{folder}")

    # -- reading ---------------------------------------------------------------

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def folders(self, at: Snapshot | None = None, parts: Iterable[Part] | None = None) -> list[str]:
        at = at or self.snapshot()
        return [
            f"{self.data}/{FOLDER}={p.folder}" + below
            for p in (at.parts if parts is None else parts)
            for below in ([""] if p.whole else [f"/{BUCKET}={b}" for b in p.buckets])
        ]

    def read(self, buckets: Sequence[int] | None = None, at: Snapshot | None = None, parts: Iterable[Part] | None = None) -> DataFrame:
        """The rows in force, or those of some ``buckets`` or some ``parts``. The filter on buckets prunes folders."""
        at = at or self.snapshot()
        schema = self.schema or (T.StructType.fromJson(json.loads(at.schema)) if at.schema else None)
        if schema is None:
            raise FileNotFoundError(f"nothing is committed to {self.path}")
        folders = self.folders(at, parts)
        if not folders:
            return empty_frame(self.lake.spark, schema)
        full = T.StructType([*schema.fields, T.StructField(FOLDER, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        rows = self.lake.spark.read.schema(full).option("basePath", self.data).parquet(*folders)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(list(buckets)))
        return rows.select(*schema.names)

    def changed_since(self, before: Snapshot, now: Snapshot, columns: Sequence[str]) -> DataFrame:
        """Distinct ``columns`` of rows that came, went or differ between two snapshots; only buckets touched since are read.

        Where rows have only been added, they alone are read.
        """
        _, buckets = touched(before, now)
        if not buckets:
            return self.read(at=now, parts=()).select(*columns)
        if new := fresh_parts(before, now):
            return self.read(at=now, parts=new).select(*columns).distinct()
        both = self.read(buckets, now).withColumn("_came", F.lit(1)).unionByName(
            self.read(buckets, before).withColumn("_came", F.lit(-1)))
        rows = [c for c in both.columns if c != "_came"]
        return both.groupBy(*rows).agg(F.sum("_came").alias("_came")).where("_came <> 0").select(*columns).distinct()

    # -- writing ---------------------------------------------------------------

    def dealt(self, df: DataFrame, buckets: int) -> DataFrame:
        """The rows shuffled so that a task has few buckets, and a bucket few tasks."""
        return df.withColumn(BUCKET, self.bucket(buckets)).hint("rebalance", BUCKET).drop(BUCKET)

    def _write(
        self, df: DataFrame, buckets: int, load_id: str, counted: Sequence[str] = (), ordered: bool = False, dealt: bool = False,
    ) -> tuple[Part, dict]:
        """One folder of rows, and how many rows have each of the flags ``counted``, which are not stored.

        Rows are counted by the tasks that write them, so no second job reads them again. Rows that are ``dealt``
        already, as those read from a table with these buckets and not shuffled since, are not shuffled again: their
        files are about as many as those they were read from.
        """
        folder, seen = f"w{uuid.uuid4().hex}", Observation()
        flags = [F.count_if(c).alias(c) for c in counted]
        rows = (df if dealt else self.dealt(df, buckets)).withColumn(BUCKET, self.bucket(buckets))
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *flags).drop(*counted)
        if ordered:
            rows = rows.sortWithinPartitions(BUCKET, self.key)
        rows.write.partitionBy(BUCKET).option("compression", "zstd").parquet(f"{self.data}/{FOLDER}={folder}")
        found = [n for n in self.lake.children(f"{self.data}/{FOLDER}={folder}") if n.startswith(f"{BUCKET}=")]
        numbers = tuple(sorted(int(n.split("=")[1]) for n in found))
        return Part(folder, (load_id,), numbers, True, seen.get["rows"]), seen.get

    def append(
        self, df: DataFrame, load_id: str, before: Snapshot | None = None, replacing: bool = False,
        built_from: dict[str, int] | None = None, dealt: bool = False,
    ) -> int:
        """Add rows; ``replacing`` puts them in the place of those of an earlier write with this ``load_id``."""
        before = before or self.snapshot()
        part, _ = self._write(df, before.buckets, load_id, dealt=dealt)
        kept = tuple(p for p in before.parts if not (replacing and p.loads == (load_id,)))
        gone = sum(p.rows for p in before.parts) - sum(p.rows for p in kept)
        self._commit(before, parts=(*kept, part) if part.rows else kept, rows=before.rows - gone + part.rows, schema=_schema(df),
                     built_from=before.built_from if built_from is None else built_from)
        return part.rows

    def overwrite(
        self, df: DataFrame, load_id: str, built_from: dict[str, int] | None = None, buckets: int | None = None, dealt: bool = False,
    ) -> int:
        """Replace all rows, in another number of ``buckets`` if asked for. ``df`` may read the table."""
        before = self.snapshot()
        buckets = buckets or before.buckets
        part, _ = self._write(df, buckets, load_id, dealt=dealt)
        self._commit(before, parts=(part,) if part.rows else (), rows=part.rows, schema=_schema(df), built_from=built_from or {},
                     buckets=buckets)
        return part.rows

    def rewrite(
        self, df: DataFrame, buckets: Sequence[int], load_id: str, before: Snapshot, counted: Sequence[str] = (),
        added: str | None = None, built_from: dict[str, int] | None = None, dealt: bool = False,
    ) -> dict:
        """Replace the rows of some buckets by ``df``'s, which must be all that these buckets hold from now on.

        Returns how many rows have each of the flags ``counted``. Where the flag ``added`` marks new rows, the
        table's row count is carried on by it; without it the old buckets are counted.
        """
        gone = 0 if added else self.read(buckets, before).count()
        part, seen = self._write(df, before.buckets, load_id, counted, dealt=dealt)
        kept = []
        for p in before.parts:
            left = tuple(b for b in p.buckets if b not in set(buckets))
            if left:
                kept.append(replace(p, buckets=left, whole=p.whole and left == p.buckets))
        rows = before.rows + (seen[added] if added else part.rows - gone)
        self._commit(before, parts=(*kept, part) if part.rows else tuple(kept), rows=rows, schema=_schema(df.drop(*counted)),
                     built_from=before.built_from if built_from is None else built_from)
        return seen

    def carry(self, built_from: dict[str, int]) -> None:
        """Note that the table is up to date with newer entries of the tables it is built from."""
        before = self.snapshot()
        if before.built_from != built_from:
            self._commit(before, built_from=built_from)

    def compact(self, buckets: int | None = None, most: int = 1) -> bool:
        """Put all folders into one, sorted by key within each bucket, so that files are few and their key ranges narrow.

        Does nothing up to ``most`` folders, unless another number of ``buckets`` is asked for:
        as a table grows, it should have so many that the buckets of a batch are a few
        gigabytes each. The rows stay the same, which the log notes.
        """
        before = self.snapshot()
        buckets = buckets or before.buckets
        if not before.parts or (len(before.parts) <= most and buckets == before.buckets):
            return False
        part, _ = self._write(self.read(at=before), buckets, "compaction", ordered=True)
        if part.rows != before.rows:
            raise RuntimeError(f"{self.path} has {before.rows} rows, but {part.rows} were written")
        merged = () if buckets != before.buckets else tuple(
            n for p in before.parts for n in (p.folder, *p.merged))
        loads = tuple(sorted({n for p in before.parts for n in p.loads} | {"compaction"}))
        self._commit(before, parts=(replace(part, loads=loads, merged=merged),), buckets=buckets)
        return True


def _schema(df: DataFrame) -> str:
    return json.dumps(df.schema.jsonValue())
