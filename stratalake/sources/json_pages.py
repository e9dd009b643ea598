"""Event pages landed as JSON documents, one per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratalake.functions import safe_timestamp
from stratalake.schemas import ENROLLMENT_EVENTS, EVENT_PAGE_SCHEMA


CORRUPT = "_corrupt_record"
_READ_SCHEMA = StructType([*EVENT_PAGE_SCHEMA.fields, StructField(CORRUPT, StringType())])


def _reason() -> Column:
    """What is wrong with a page; NULL for a whole one."""
    return (
        F.when(F.col(CORRUPT).isNotNull(), "not a page in JSON")
        .when(F.col("data").isNull(), "no list of events")
        .when(F.col("count") != F.size("data"), "not as many events as it says")
    )


def _events(pages: DataFrame) -> DataFrame:
    """The events of whole pages, and those that a page with another count does hold."""
    return pages.select(F.explode("data").alias("e")).select(*[F.col(f"e.{c}") for c in ENROLLMENT_EVENTS.columns])


def event_pages(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The events of all landed pages, as text columns. Empty pages give no rows.

    File options such as ``modifiedAfter`` narrow the pages that are read.
    """
    return _events(_landed(spark, folder, **options))


def _landed(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    reader = spark.read.schema(_READ_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.options(recursiveFileLookup="true", **options).json(folder)


def broken_pages(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """``file, reason, page`` of every landed line that is not a whole page.

    A page is one line: one that is cut off, or laid out over several lines, gives a row per
    line. ``page`` is the line as it stands, where it is not JSON.
    """
    return _broken(_landed(spark, folder, **options).withColumn("file", F.col("_metadata.file_path")))


def _broken(pages: DataFrame) -> DataFrame:
    found = pages.withColumn("reason", _reason()).where("reason is not null")
    return found.select("file", "reason", F.col(CORRUPT).alias("page"))


def stream_event_pages(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The landed pages, whole or not; ``split_pages`` takes a micro-batch of them apart."""
    reader = spark.readStream.schema(_READ_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder).withColumn("file", F.col("_metadata.file_path"))


def split_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The events as by ``event_pages``, and what is broken as by ``broken_pages``."""
    return _events(pages), _broken(pages)


def events_since(events: DataFrame, since: str) -> DataFrame:
    """Events that happened at or after ``since`` (inclusive, unlike tables).

    Events without a readable time may have happened then, and are kept, as a stream keeps them.
    """
    time = safe_timestamp("event_time")
    return events.where(time.isNull() | (time >= F.lit(since).cast("timestamp_ntz")))
