"""Landed files and operational tables made by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance import adapter as A
from stratalake import schemas as S
from stratalake.functions import safe_date, safe_decimal, safe_timestamp
from stratalake.operators import pages

PAGE_SIZE = 500
HALFWAY_DROP = "pharmacy_claims_19950601_00.csv"
FEED_ORDER = ("created_at", "event_id", "plan_code")


def write_csv_drops(spark: SparkSession, sf_dir: str, folder: str, half: int | None = None) -> None:
    """One drop per month: nine columns before the cutoff, ten from then on. Of two halves the second has the later drops."""
    rows = A.pharmacy_drop_rows(spark, sf_dir).withColumnRenamed(S.SOURCE_FILE, "drop")
    if half is not None:
        later = F.col("drop") >= HALFWAY_DROP
        rows = rows.where(later if half else ~later)
    first_v2 = f"pharmacy_claims_{A.NPI_CUTOFF.replace('-', '')}_00.csv"
    for frame in (rows.where(F.col("drop") < first_v2).drop("pharmacy_npi"), rows.where(F.col("drop") >= first_v2)):
        writer = frame.hint("rebalance", "drop").write.mode("append").partitionBy("drop")
        writer.option("header", True).option("escape", '"').csv(folder)


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.bronze_enrollment_events(spark, sf_dir).select(*S.ENROLLMENT_EVENTS.columns)


def write_event_pages(spark: SparkSession, sf_dir: str, folder: str, half: int | None = None) -> None:
    feed = event_feed(spark, sf_dir)
    if half is not None:  # any event may come late
        feed = feed.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half)
    pages(feed, FEED_ORDER, PAGE_SIZE).drop("cursor").write.mode("append").json(folder)


def operational_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Typed tables as a database would serve them.

    The given rows are older than the first watermark, so their update times
    are moved up by a fixed number of days, which keeps their order. A database
    has an update time for every row: where the given one is none, it is the time of creation.
    Claims have their order besides, by which they are dealt out.
    """
    dates, times = ("service_date", "date_of_birth", "effective_date"), ("created_at", "updated_at")
    amounts = ("billed_amount", "allowed_amount")

    def typed(bronze: DataFrame, spec: S.TableSpec, *also: str) -> DataFrame:
        return bronze.select(*also, *[
            (F.coalesce(safe_timestamp(c), safe_timestamp("created_at")) + F.expr("INTERVAL 4000 DAYS")
             if c == spec.watermark_column
             else safe_date(c) if c in dates else safe_timestamp(c) if c in times
             else safe_decimal(c, 12, 2) if c in amounts else F.col(c)).alias(c)
            for c in spec.columns
        ])

    return {
        "medical_claims": typed(A.dealt_medical_claims(spark, sf_dir), S.MEDICAL_CLAIMS, A.CLAIM_ORDER),
        "members": typed(A.bronze_members(spark, sf_dir), S.MEMBERS),
        "providers": typed(A.bronze_providers(spark, sf_dir), S.PROVIDERS),
    }
