"""Metric log records: text, severity, labels and a typed payload."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRIC_MARK = "METRIC:"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("service", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "payload",
            T.StructType(
                [
                    T.StructField("latency_ms", T.DoubleType()),
                    T.StructField("write_ms", T.DoubleType()),
                    T.StructField("size_bytes", T.LongType()),
                    T.StructField("queue_depth", T.LongType()),
                ]
            ),
        ),
    ]
)


def read_metric_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).json(path)


def metric_lines(
    log: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """Records carrying a metric name, within [start, end)."""
    lines = log.filter(F.col("text").contains(METRIC_MARK))
    if start is not None:
        lines = lines.filter(F.col("ts") >= F.lit(start))
    if end is not None:
        lines = lines.filter(F.col("ts") < F.lit(end))
    return lines
