"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: What the engine relies on. Shuffle sizes are left to the cluster: AQE
#: coalesces small partitions and splits skewed ones.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "stratalake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder on this machine, which goes
    when Python ends. Whichever folder it is, ``DataFrame.checkpoint()`` is made to work in it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    in_use = context.getCheckpointDir()
    if not folder:
        if in_use:  # Spark adds a folder of its own below the one it was given
            return in_use.rstrip("/").rsplit("/", 1)[0]
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="stratalake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if not in_use:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    """A folder name of its own for one run, below the shared folder."""
    return f"{shared_folder(spark)}/stratalake/{label}-{uuid.uuid4().hex}"


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, and the optimizer knows it: joins with it fold away."""
    return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
