"""Input tables and intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stratalake.lake import Lake
from stratalake.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table below ``spark.checkpoint.dir``, read again.

    Cuts the lineage, survives lost executors, and forgets how rows were dealt
    out, so that a join with it can be split where a key is frequent. A
    table may be ``removed`` once the results that rest on it are written.
    """
    folder = scratch_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    table = df.sparkSession.read.schema(df.schema).parquet(folder)
    table.written_to = folder
    return table


def removed(*tables: DataFrame) -> None:
    """Remove tables that ``written`` has made, once all that is computed from them is written."""
    for table in tables:
        Lake(table.sparkSession, table.written_to).remove(table.written_to)
