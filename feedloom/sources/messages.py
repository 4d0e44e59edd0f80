"""Topic messages: schema, batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INNER = T.StructType(
    [
        T.StructField("data", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("messageId", T.StringType()),
        T.StructField("message_id", T.StringType()),
    ]
)

# A message is either wrapped in ``message`` or carries the same members itself.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("message", _INNER),
        T.StructField("data", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("messageId", T.StringType()),
        T.StructField("publishTime", T.TimestampType()),
        T.StructField("delivery_attempt", T.IntegerType()),
    ]
)


def read_messages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).format(fmt).load(path)


def stream_messages(
    spark: SparkSession, path: str, fmt: str = "json", files_per_trigger: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .format(fmt)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records (value, timestamp) as messages; ``value`` holds the message JSON."""
    parsed = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA)
    return records.select(parsed.alias("m"), "timestamp").select(
        "m.message",
        "m.data",
        "m.attributes",
        "m.messageId",
        F.coalesce("m.publishTime", "timestamp").alias("publishTime"),
        "m.delivery_attempt",
    )
