"""Ordering that stays balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir


def ordered_blocks(df: DataFrame, *order: str, blocks: int | None = None) -> DataFrame:
    """Range-partitions rows by a total order and tags each with its block number.

    Blocks follow one another in the order and hold similar row counts, whatever the key
    distribution.  The result is checkpointed so that block numbers, which come from sampled
    range bounds, stay the same however often it is read and whichever executor is lost.
    """
    spark = df.sparkSession
    shared_dir(spark)
    count = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.repartitionByRange(count, *order)
        .withColumn("_block", F.spark_partition_id())
        .checkpoint(eager=True)
    )
