"""The database change feed as a file source (the same schema fits a Kafka value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("operationType", T.StringType()),
        T.StructField("clusterTime", T.TimestampType()),
        T.StructField(
            "ns",
            T.StructType([T.StructField("db", T.StringType()), T.StructField("coll", T.StringType())]),
        ),
        T.StructField("documentKey", T.VariantType()),
        T.StructField("fullDocument", T.VariantType()),
    ]
)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHANGE_SCHEMA).json(path)


def stream_changes(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Change events from JSON files as they arrive, ``files_per_trigger`` files a batch."""
    return (
        spark.readStream.schema(CHANGE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(path)
    )
