"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Compressed bytes that one task reads from files, or takes from a shuffle, so that its memory does not grow with the
#: input: documents and payloads are many times as large once they are rows and sorted.
SHARE_BYTES = 16 << 20

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHARE_BYTES),
    "spark.sql.files.maxPartitionBytes": str(SHARE_BYTES),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str = "*", app: str = "feedloom") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans rely on (UTC, AQE, dynamic overwrite)."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    Clusters name it in ``spark.checkpoint.dir``, and without it nothing is written there.  Only a
    local session, whose executors share the driver's disk, gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="feedloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, unique to this call."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table, with zone-less timestamps turned into UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    casts = {
        field.name: df[field.name].cast("timestamp")
        for field in df.schema.fields
        if field.dataType.typeName() == "timestamp_ntz"
    }
    return df.withColumns(casts) if casts else df


#: Bytes of Parquet whose rows one task turns into documents or messages, which are some seventy times as large.
SPREAD_BYTES = 1 << 20


def spread(df: DataFrame, driving: DataFrame) -> DataFrame:
    """Spreads rows ahead of CPU-heavy work: over all cores, and so that no task's share grows with the input.

    ``driving`` is the plain scan that ``df`` grows with.  Where it has as many splits already, nothing is shuffled.
    """
    scanned = int(str(driving._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-scanned // SPREAD_BYTES))
    return df.repartition(tasks) if driving.rdd.getNumPartitions() < tasks else df
