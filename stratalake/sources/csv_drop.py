"""CSV drops whose column count changes over time, read by position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.schemas import PHARMACY_CLAIMS, SOURCE_FILE
from stratalake.sources.csv_records import csv_records

#: By position: a short row gets NULLs at its end, surplus fields are ignored,
#: no row is refused. An empty field is NULL. The header is skipped, not matched.
READ_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "recursiveFileLookup": "true",
    "pathGlobFilter": "*.{csv,csv.gz}",
}


def _without_end(text: str, n: Column) -> Column:
    return F.substr(F.col(text), F.lit(1), F.length(text) - n)


def _with_source(raw: DataFrame, folder: str, file: Column | None = None) -> DataFrame:
    """The drops' columns and the drop a row came from: its path below the landing folder.

    Without the suffix compression adds, so a plain and a compressed copy count
    as one source; drops of one name in different folders are different sources. A drop may also be a
    folder of part files, named after the drop, with or without ``name=`` before it. This runs
    per row, so paths are cut at fixed places, each step once, in code small enough for the JVM to compile.
    """
    path = raw.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(raw.sparkSession._jsc.hadoopConfiguration())
    uri = files.makeQualified(path).toUri()
    base = uri.getRawPath().rstrip("/")
    start = f"{uri.getScheme()}://{uri.getRawAuthority() or ''}{base}/"
    rows = raw.select(*PHARMACY_CLAIMS.columns, (F.col("_metadata.file_path") if file is None else file).alias("_path"))
    place = F.regexp_replace("_path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    below = F.when(F.col("_path").startswith(start), F.substr("_path", F.lit(len(start) + 1))).otherwise(
        F.substr(place, F.lit(len(base) + 2))) if base else F.substring_index("_path", "/", -1)
    rows = rows.withColumn("_below", below)
    rows = rows.withColumn("_parent", _without_end("_below", F.length(F.substring_index("_below", "/", -1)) + 1))
    plain = F.when(F.endswith("_below", F.lit(".gz")), _without_end("_below", F.lit(3))).otherwise(F.col("_below"))
    rows = rows.withColumn("_drop", F.when(F.endswith("_parent", F.lit(".csv")), F.col("_parent")).otherwise(plain))
    rows = rows.withColumn("_name", F.substring_index("_drop", "/", -1)).withColumn("_equals", F.instr("_name", "="))
    unnamed = F.concat(_without_end("_drop", F.length("_name")), F.substr("_name", F.col("_equals") + 1))
    source = F.when(F.col("_equals") > 1, unnamed).otherwise(F.col("_drop"))
    return rows.select(*PHARMACY_CLAIMS.columns, source.alias(SOURCE_FILE))


def csv_drops(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """All drops below a folder, every column as text, with ``_source_file``.

    Plain files are split over tasks. A ``.gz`` file is one task, as gzip
    cannot be split; large drops should come plain or in parts.
    """
    reader = spark.read.schema(PHARMACY_CLAIMS.source_schema).options(**READ_OPTIONS)
    return _with_source(reader.options(**options).csv(folder), folder)


def csv_drops_with_breaks(spark: SparkSession, folder: str, by_name: bool = False, kept: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The drops as by ``csv_drops``, but quoted fields may hold line breaks, and lines of records without an end.

    ``by_name`` takes columns by each file's header instead of by position. Files are
    still split over tasks; their lines are shuffled once to be put together, and written to ``kept``.
    """
    rows, broken = csv_records(spark, folder, PHARMACY_CLAIMS.columns, by_name, kept, pathGlobFilter=READ_OPTIONS["pathGlobFilter"])
    return _with_source(rows, folder, F.col("file")), broken


def stream_csv_drops(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The same drops as a stream; its checkpoint makes each file be read once."""
    reader = spark.readStream.schema(PHARMACY_CLAIMS.source_schema).options(**READ_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _with_source(reader.csv(folder), folder)


def split_incomplete(drops: DataFrame, required: Sequence[str] = ("claim_id",)) -> tuple[DataFrame, DataFrame]:
    """Rows with all ``required`` columns, and the others with the missing ones named."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return drops.where(complete), drops.where(~complete).withColumn("missing", missing)
