"""Alert rules evaluated over the metric log and the checkpoints."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counters import counters_per_period
from .metrics import streaks

# Documented limits.
FORMAT_ERRORS_PER_MINUTE = 10
UNEXPECTED_ERRORS_PER_MINUTE = 5
SLOW_SHARE = 0.01
HIGH_LATENCY_SHARE = 0.05
CHECKPOINT_FAILURES = 3
STALL_MINUTES = 10


def log_alerts(
    log: DataFrame, as_of: dt.datetime, services: dict[str, str] | None = None
) -> DataFrame:
    """One row per rule: (rule, observed, limit, firing), from per-minute counts in one pass.

    Error rules look at their worst minute, share rules at the whole log, the stall rule at
    the events since ``as_of`` minus the stall period.
    """
    names = [
        "data_loss_events",
        "format_errors",
        "unexpected_errors",
        "slow_publishes",
        "high_latency_operations",
        "change_stream_events",
        "pubsub_published",
    ]
    timed = F.count_if(F.col("text").contains("latency")).alias("timed")
    minutes = counters_per_period(log, 60, names, services, also=(timed,))
    since = F.lit(as_of - dt.timedelta(minutes=STALL_MINUTES))
    totals = minutes.agg(
        F.coalesce(F.sum("data_loss_events"), F.lit(0)).cast("double").alias("data_loss"),
        F.coalesce(F.max("format_errors"), F.lit(0)).cast("double").alias("format_errors"),
        F.coalesce(F.max("unexpected_errors"), F.lit(0)).cast("double").alias("unexpected_errors"),
        F.coalesce(F.try_divide(F.sum("slow_publishes"), F.sum("pubsub_published")), F.lit(0.0)).alias("slow_publish_share"),
        F.coalesce(F.try_divide(F.sum("high_latency_operations"), F.sum("timed")), F.lit(0.0)).alias("high_latency_share"),
        F.coalesce(F.sum(F.when(F.col("period_start") >= since, F.col("change_stream_events"))), F.lit(0)).cast("double").alias("stall"),
    )
    limits = {
        "data_loss": 0.0,
        "format_errors": float(FORMAT_ERRORS_PER_MINUTE),
        "unexpected_errors": float(UNEXPECTED_ERRORS_PER_MINUTE),
        "slow_publish_share": SLOW_SHARE,
        "high_latency_share": HIGH_LATENCY_SHARE,
        "stall": 0.0,
    }
    long = totals.unpivot([], list(limits), "rule", "observed")
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    with_limit = long.withColumn("limit", F.try_element_at(limit, F.col("rule")))
    share = F.col("rule").isin("slow_publish_share", "high_latency_share")
    return with_limit.withColumn(
        "firing",
        F.when(F.col("rule") == "stall", F.col("observed") <= F.col("limit"))
        .when(share, F.col("observed") >= F.col("limit"))
        .otherwise(F.col("observed") > F.col("limit")),
    )


def checkpoint_alert(checkpoints: DataFrame, limit: int = CHECKPOINT_FAILURES) -> DataFrame:
    """Runs of consecutive checkpoint failures and whether they reach the limit."""
    rows = checkpoints.select("ts", F.col("checkpoint_id").alias("seq"), "ok")
    return streaks(rows, ~F.col("ok"), F.col("ok")).select(
        F.col("first_seq").alias("first_checkpoint"),
        "started_at",
        F.col("length").alias("failures"),
        (F.col("length") >= limit).alias("firing"),
    )
