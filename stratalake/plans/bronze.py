"""Idempotent loads into bronze: stage, one row per key, merge, commit, audit."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake import watermark
from stratalake.functions import iso_text
from stratalake.keyed import KeyedTable, Snapshot
from stratalake.lake import Lake
from stratalake.operators import latest_by, unmatched, upsert
from stratalake.schemas import ENROLLMENT_EVENTS, LOADED_AT, PHARMACY_CLAIMS, TableSpec
from stratalake.session import empty_frame
from stratalake.sources import (
    as_text, broken_pages, changed_since, csv_drops, csv_drops_with_breaks, event_pages, events_since, split_incomplete,
)

#: An operational table, or a function from a start time to the table.
Source = DataFrame | Callable[[str], DataFrame]

log = logging.getLogger(__name__)

#: Times further ahead of a load's clock than this do not move its watermark.
AHEAD = "1 DAY"


@dataclass(frozen=True)
class LoadAudit:
    """What one load did. ``since`` and ``watermark`` are NULL without a watermark."""

    table: str
    load_id: str
    since: str | None
    rows_in: int
    rows_deduped: int | None
    rows_inserted: int
    rows_updated: int
    rows_total: int | None
    rows_incomplete: int
    watermark: str | None


AUDIT_SCHEMA = (
    "table string, load_id string, since string, rows_in long, rows_deduped long, "
    "rows_inserted long, rows_updated long, rows_total long, rows_incomplete long, watermark string"
)


def audit_frame(spark: SparkSession, audits: Sequence[LoadAudit]) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(a).values()) for a in audits], AUDIT_SCHEMA)


def bronze_table(lake: Lake, spec: TableSpec) -> KeyedTable:
    """A bronze table, in buckets by the first column of its key, which is its silver table's key."""
    return lake.keyed("bronze", spec.bronze_name, spec.key[0], spec.bronze_schema)


def read_bronze(lake: Lake, spec: TableSpec) -> DataFrame:
    return bronze_table(lake, spec).read()


def load_batch(
    lake: Lake,
    spec: TableSpec,
    batch: DataFrame,
    load_id: str | None = None,
    loaded_at: str | None = None,
    since: str | None = None,
    full_audit: bool = True,
    required: Sequence[str] = (),
    fixed_batch: bool = False,
    reset_watermark: bool = False,
) -> LoadAudit:
    """Merge a batch into its bronze table, then move the watermark.

    The batch is staged first, so its source is read once; rows, newest time and
    buckets are counted by the tasks that stage it. The merge reads the batch's
    buckets of the table only, and becomes visible as a whole. Loading again after
    a failure adds only what is missing. With ``fixed_batch`` the ``load_id``
    stands for exactly this batch, as a stream's does, and a second load
    replaces the first, which also keeps rows with a NULL key from doubling.
    ``full_audit=False`` leaves the count of distinct keys, which shuffles the
    batch's keys once more, out of an insert-only load's audit. Rows without one of the
    ``required`` columns go to the table ``incomplete_...`` instead. Rows dated
    more than ``AHEAD`` in the future are loaded but do not move the watermark;
    ``reset_watermark`` sets it by this batch alone, as a full pull does.
    """
    load_id = load_id or datetime.now().strftime("%Y%m%dT%H%M%S%f")
    table = bronze_table(lake, spec)
    before = table.snapshot()
    clock = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else F.localtimestamp()
    metrics = [F.count(F.lit(1)).alias("rows"), F.collect_set(table.bucket(before.buckets)).alias("buckets")]
    if spec.watermark_column:
        until = F.greatest(clock, F.localtimestamp()) + F.expr(f"INTERVAL {AHEAD}")
        metrics.append(iso_text(watermark.newest_time(spec.watermark_column, until)).alias("newest"))
    staged_at, staged, seen = lake.stage(spec.name, as_text(batch.select(*spec.batch_columns)), load_id, *metrics)
    try:
        return _merge_staged(table, spec, staged, seen, before, load_id, clock, since, full_audit, required, fixed_batch, reset_watermark)
    finally:
        lake.remove(staged_at)


def _merge_staged(
    table: KeyedTable, spec: TableSpec, staged: DataFrame, seen: dict, before: Snapshot, load_id: str, clock: Column,
    since: str | None, full_audit: bool, required: Sequence[str], fixed_batch: bool, reset_watermark: bool,
) -> LoadAudit:
    lake, rows_in = table.lake, seen["rows"]
    if not rows_in:
        log.warning("%s: nothing to load", spec.name)
        return LoadAudit(spec.name, load_id, since, 0, 0, 0, 0, before.rows, 0, None)

    incomplete = 0
    if required:
        staged, lacking = split_incomplete(staged, required)
        incomplete = lake.append_load("bronze", f"incomplete_{spec.name}", lacking, load_id, fixed_batch)

    one_per_key = latest_by(staged, spec.key, spec.order_by, spec.newest)
    batch_keys, buckets = staged.select(*spec.key).distinct(), sorted(seen["buckets"])
    keys = inserted = updated = 0
    if spec.update_on_match:
        merged = upsert(table.read(buckets, before), one_per_key.withColumn(LOADED_AT, clock), spec.key, keep=[LOADED_AT],
                        newer_by=spec.newer_by, flags=True)
        counts = table.rewrite(merged, buckets, load_id, before, counted=["_inserted", "_matched"], added="_inserted")
        inserted, updated = counts["_inserted"], counts["_matched"]
        keys = inserted + updated
    else:
        keys = batch_keys.count() if full_audit else None
        if not (fixed_batch and before.merged_load(load_id)):  # else it is there, in a folder with others
            known = [p for p in before.parts if not (fixed_batch and p.loads == (load_id,))]
            fresh = unmatched(one_per_key, table.read(buckets, before, known), spec.key, batch_keys=batch_keys, rows=rows_in)
            inserted = table.append(fresh.withColumn(LOADED_AT, clock), load_id, before, replacing=fixed_batch)

    newest = None
    if spec.watermark_column:
        mark = lake.spark.createDataFrame([(spec.source_name, seen["newest"])], "source_name string, last_watermark string")
        newest = watermark.commit(lake, spec.source_name, mark, reset_watermark)
    audit = LoadAudit(spec.name, load_id, since, rows_in, keys, inserted, updated, table.snapshot().rows, incomplete, newest)
    log.info("loaded %s", audit)
    return audit


def load_pharmacy_drops(
    lake: Lake, folder: str, load_id: str | None = None, loaded_at: str | None = None, required: Sequence[str] = (),
    full_audit: bool = True, line_breaks: bool = False, by_name: bool = False,
) -> LoadAudit:
    """Load every CSV drop in a folder; drops loaded before add nothing.

    Reads all files each time. ``streaming.follow_pharmacy_drops`` reads each
    file once. With ``line_breaks`` quoted fields may hold them; ``by_name``, which
    reads files the same way, takes columns by each file's header. Lines without an end of
    their record are then kept in the table ``incomplete_drop_lines`` and counted as incomplete.
    """
    load_id = load_id or datetime.now().strftime("%Y%m%dT%H%M%S%f")
    lost, kept = 0, f"{lake.path('staging', 'drop_lines')}/{load_id}"
    if not lake.exists(folder):
        drops = empty_frame(lake.spark, PHARMACY_CLAIMS.bronze_schema)
    elif line_breaks or by_name:
        drops, broken = csv_drops_with_breaks(lake.spark, folder, by_name, kept)
        lost = lake.append_load("bronze", "incomplete_drop_lines", broken, load_id, replace=True)
        if lost:
            log.warning("%s: %d lines of broken records, see incomplete_drop_lines", PHARMACY_CLAIMS.name, lost)
    else:
        drops = csv_drops(lake.spark, folder)
    audit = load_batch(lake, PHARMACY_CLAIMS, drops, load_id, loaded_at, full_audit=full_audit, required=required)
    lake.remove(kept)
    return replace(audit, rows_incomplete=audit.rows_incomplete + lost)


def load_event_pages(
    lake: Lake,
    folder: str,
    full: bool = False,
    lookback: str = ENROLLMENT_EVENTS.lookback,
    load_id: str | None = None,
    loaded_at: str | None = None,
    full_audit: bool = True,
    **options: str,
) -> LoadAudit:
    """Load landed event pages from the watermark, minus the lookback, on.

    Lines that are no whole page are kept in the table ``incomplete_event_pages``
    and counted as incomplete; the pages around them are loaded.
    """
    spec = ENROLLMENT_EVENTS
    since = watermark.read_since(lake, spec.source_name, lookback, full)
    load_id = load_id or datetime.now().strftime("%Y%m%dT%H%M%S%f")
    broken = broken_pages(lake.spark, folder, **options)
    lost = lake.append_load("bronze", "incomplete_event_pages", broken, load_id, replace=True)
    if lost:
        log.warning("%s: %d broken pages, see incomplete_event_pages", spec.name, lost)
    events = events_since(event_pages(lake.spark, folder, **options), since)
    audit = load_batch(lake, spec, events, load_id, loaded_at, since, full_audit, reset_watermark=full)
    return replace(audit, rows_incomplete=audit.rows_incomplete + lost)


def load_changed_table(
    lake: Lake,
    spec: TableSpec,
    source: Source,
    full: bool = False,
    lookback: str | None = None,
    load_id: str | None = None,
    loaded_at: str | None = None,
    full_audit: bool = True,
) -> LoadAudit:
    """Load the rows of an operational table changed since its watermark, minus the lookback.

    ``source`` is the table, or a function that opens it given the time from
    which rows are wanted, such as one calling ``jdbc_table``.
    """
    since = watermark.read_since(lake, spec.source_name, lookback or spec.lookback, full)
    if callable(source):
        source = source(since)
    changed = changed_since(source, spec, since)
    return load_batch(lake, spec, changed, load_id, loaded_at, since, full_audit, reset_watermark=full)
