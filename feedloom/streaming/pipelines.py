"""Structured Streaming forms: archive consumer, transform consumer, counters per period.

Each consumer is its own query with its own checkpoint, so one can lag or restart without the
other.  Batch logic is reused per micro-batch through ``foreachBatch``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ledger
from ..operators.archive import archive_rows, write_archive
from ..operators.decode import decode
from ..plans.collections import REGISTRY
from ..plans.counters import COUNTERS, counters_per_period
from ..plans.ingest import write_all_tables


def archive_consumer(
    messages: DataFrame, path: str, checkpoint: str, as_of: Column | None = None
) -> StreamingQuery:
    """Raw archive: each message once, by collection and date.

    Every micro-batch goes through the batch writer, which drops copies within the batch ahead
    of its shuffle and messages archived before by their id.  No state is kept and no copy
    is ever too late to be recognised; a batch tried again adds nothing twice.
    """
    rows = archive_rows(decode(messages), as_of)
    return (
        rows.writeStream.foreachBatch(lambda batch, _number: write_archive(batch, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def transform_consumer(
    messages: DataFrame,
    out: str,
    staging: str,
    checkpoint: str,
    as_of: Column | None = None,
    collections: Iterable[str] = tuple(REGISTRY),
) -> StreamingQuery:
    """Collection tables, skipped, rejected and drift rows from a message stream, each message once.

    A micro-batch is written as a batch is, into the same tables: a document already there by its
    (inner) message id and position is left out, however late its copy comes, and a batch tried
    again adds nothing.  No state is kept and no row is ever too late.
    """
    return (
        messages.writeStream.foreachBatch(
            lambda batch, _number: write_all_tables(batch, out, staging, as_of, collections)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def counter_stream(
    log: DataFrame,
    path: str,
    checkpoint: str,
    seconds: int = 300,
    counters: Iterable[str] = tuple(COUNTERS),
    services: dict[str, str] | None = None,
) -> StreamingQuery:
    """Counters per period from a log stream, however late and in whatever order its rows come.

    Every micro-batch leaves its partial counts, one row per period that it touches, under its own number; a
    batch tried again replaces its rows.  ``read_counters`` adds the parts up, so no state is kept, no watermark
    is needed and no row is ever too late.
    """
    counters = tuple(counters)
    stream = "s" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]  # two streams may share a table

    def write(batch: DataFrame, number: int) -> None:
        parts = counters_per_period(batch, seconds, counters, services)
        ledger.put(parts.withColumn("day", F.to_date("period_start")), path, f"{stream}-{number}", ["day"])

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _added(parts: DataFrame) -> DataFrame:
    names = [c for c in parts.columns if c not in ("period_start", "day")]
    return parts.groupBy("day", "period_start").agg(*[F.sum(c).alias(c) for c in names])


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """All periods met so far, with their counts so far."""
    return _added(ledger.read_committed(spark, path)).drop("day")


def compact_counters(spark: SparkSession, path: str) -> None:
    """Adds the parts up into one row per period, in one step for readers."""
    ledger.merge(spark, path, lambda parts: _added(parts).select(*parts.columns), ["day"])
