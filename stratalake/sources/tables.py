"""Operational tables, pulled by their ``updated_at``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stratalake.functions import safe_timestamp
from stratalake.schemas import TableSpec


def changed_since(source: DataFrame, spec: TableSpec, since: str) -> DataFrame:
    """The load columns of rows changed after ``since`` (exclusive).

    The bound is a literal of the column's own type, so it reaches a Parquet
    scan or a database as a filter. Text is compared as times, not as text. Rows
    without a readable time may have changed, and are pulled.
    """
    kind = source.schema[spec.watermark_column].dataType
    start = F.lit(since).cast("timestamp_ntz")
    if isinstance(kind, StringType):
        time = safe_timestamp(spec.watermark_column)
        return source.select(*spec.columns).where(time.isNull() | (time > start))
    changed = F.col(spec.watermark_column)
    return source.select(*spec.columns).where(changed.isNull() | (changed > start.cast(kind)))


def as_text(source: DataFrame) -> DataFrame:
    """Every column as text, NULL staying NULL."""
    return source.select(*[F.col(c).cast("string").alias(c) for c in source.columns])


def jdbc_options(spec: TableSpec, table: str, since: str, until: str, partitions: int) -> dict[str, str]:
    """Reader options that split the changed range over ``partitions`` connections.

    ``since`` and ``until`` only place the splits; the first and last are open.
    """
    return {
        "dbtable": table,
        "partitionColumn": spec.watermark_column,
        "lowerBound": since.replace("T", " "),
        "upperBound": until.replace("T", " "),
        "numPartitions": str(partitions),
        "preferTimestampNTZ": "true",
        "fetchsize": "10000",
    }


def stride_query(spec: TableSpec, table: str, since: str, partitions: int) -> str:
    """SQL for the database: the first update time of each of so many equal shares of the changed rows."""
    time = spec.watermark_column
    changed = f"SELECT {time}, NTILE({partitions}) OVER (ORDER BY {time}) AS share FROM {table} WHERE {time} > '{since.replace('T', ' ')}'"
    return f"SELECT share, MIN({time}) AS first_time FROM ({changed}) changed GROUP BY share"


def stride_predicates(spec: TableSpec, bounds: Sequence[object]) -> list[str]:
    """A condition per connection between successive bounds: each row, and those without an update time, in exactly one."""
    time = spec.watermark_column
    cuts = sorted({str(b) for b in bounds if b is not None})[1:]
    if not cuts:
        return ["1 = 1"]
    middle = [f"{time} >= '{a}' AND {time} < '{b}'" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"({time} < '{cuts[0]}' OR {time} IS NULL)", *middle, f"{time} >= '{cuts[-1]}'"]


def jdbc_table(
    spark: SparkSession, spec: TableSpec, url: str, table: str, since: str, until: str,
    partitions: int = 16, even: bool = False, **options: str,
) -> DataFrame:
    """A database table to pull changes from, read over several connections.

    The columns and the time bound that ``changed_since`` asks for are pushed
    down by Spark's JDBC source. Connections get equal stretches of time, or, if
    ``even``, equal numbers of changed rows, for which the database is asked first.
    """
    settings = jdbc_options(spec, table, since, until, partitions)
    if even:
        reader = spark.read.format("jdbc").option("url", url).option("query", stride_query(spec, table, since, partitions))
        bounds = [r["first_time"] for r in reader.options(**options).load().collect()]  # one row per connection
        kept = {k: v for k, v in settings.items() if k in ("preferTimestampNTZ", "fetchsize")}
        return spark.read.jdbc(url, table, predicates=stride_predicates(spec, bounds), properties={**kept, **options})
    reader = spark.read.format("jdbc").option("url", url)
    return reader.options(**{**settings, **options}).load()
