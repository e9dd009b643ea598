"""The watermark table: one row per source with the newest time loaded.

Each source's row is a table of its own, so loads of different sources can
commit at the same time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import iso_text, safe_timestamp
from stratalake.lake import Lake
from stratalake.schemas import FIRST_WATERMARK, WATERMARK_SCHEMA, WATERMARK_TABLE
from stratalake.session import empty_frame


def _table(source: str) -> str:
    return f"{WATERMARK_TABLE}/{source}"


def folders(lake: Lake) -> list[str]:
    """The folders that hold the current rows."""
    found = (lake.current("bronze", _table(s)) for s in lake.children(lake.path("bronze", WATERMARK_TABLE)))
    return sorted(f for f in found if f)


def state(lake: Lake) -> DataFrame:
    """All sources' watermarks."""
    current = folders(lake)
    if not current:
        return empty_frame(lake.spark, WATERMARK_SCHEMA)
    return lake.spark.read.schema(WATERMARK_SCHEMA).parquet(*current)


def of_source(lake: Lake, source: str) -> DataFrame:
    return lake.read("bronze", _table(source), WATERMARK_SCHEMA)


def since_frame(watermarks: DataFrame, source: str, lookback: str) -> DataFrame:
    """The stored watermark of a source moved back by the lookback, as ISO text."""
    return watermarks.where(F.col("source_name") == source).select(
        iso_text(safe_timestamp("last_watermark") - F.expr(f"INTERVAL {lookback}")).alias("since")
    )


def read_since(lake: Lake, source: str, lookback: str, full: bool = False) -> str:
    """Where a pull starts. A full pull, or a source never loaded, starts at the beginning."""
    if full:
        return FIRST_WATERMARK
    row = since_frame(of_source(lake, source), source, lookback).first()
    return row["since"] if row and row["since"] else FIRST_WATERMARK


def newest_time(column: str, until: Column | None = None) -> Column:
    """The newest parseable time of a batch (NULL if none), as an aggregate.

    Times after ``until`` do not count: one row dated far ahead would otherwise
    keep all later ones out of every pull.
    """
    time = safe_timestamp(column)
    return F.max(time if until is None else F.when(time <= until, time))


def newest(batch: DataFrame, source: str, column: str, until: Column | None = None) -> DataFrame:
    """One row: the source and the ``newest_time`` of its batch."""
    return batch.agg(iso_text(newest_time(column, until)).alias("last_watermark")).select(
        F.lit(source).alias("source_name"), "last_watermark"
    )


def advance(watermarks: DataFrame, seen: DataFrame) -> DataFrame:
    """Watermarks after a load. They never move back, and a NULL moves nothing."""
    marks = seen.where(F.col("last_watermark").isNotNull()).withColumn("updated_at", F.localtimestamp())
    return watermarks.unionByName(marks).groupBy("source_name").agg(
        iso_text(F.max(safe_timestamp("last_watermark"))).alias("last_watermark"),
        F.max("updated_at").alias("updated_at"),
    )


def commit(lake: Lake, source: str, seen: DataFrame, reset: bool = False) -> str | None:
    """Store a source's advanced watermark and return it. With ``reset`` what was stored does not count.

    Call this after the data itself is committed: a crash in between only makes
    the next pull fetch the same rows again.
    """
    before = empty_frame(lake.spark, WATERMARK_SCHEMA) if reset else of_source(lake, source)
    lake.replace("bronze", _table(source), advance(before, seen).coalesce(1))
    row = of_source(lake, source).first()
    return row["last_watermark"] if row else None
