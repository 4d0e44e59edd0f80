"""Counters derived from the metric log, all counted in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGESTOR = "ingestor"
WRITER = "writer"

# Counter name -> (service it belongs to, predicate on the log text).
COUNTERS: dict[str, tuple[str | None, str]] = {
    "change_stream_events": (INGESTOR, "contains(text, 'METRIC:change_stream_event')"),
    "pubsub_published": (INGESTOR, "contains(text, 'METRIC:pubsub_published')"),
    "pubsub_publish_failed": (INGESTOR, "contains(text, 'METRIC:publish_failed')"),
    "slow_publishes": (INGESTOR, "contains(text, 'METRIC:slow_publish')"),
    "ingestor_system_stats": (INGESTOR, "contains(text, 'METRIC:system_stats')"),
    "function_messages_received": (WRITER, "contains(text, 'METRIC:message_received')"),
    "gcs_write_success": (WRITER, "contains(text, 'METRIC:gcs_write_success')"),
    "gcs_write_failed": (WRITER, "contains(text, 'METRIC:gcs_write_failed')"),
    "function_stats": (WRITER, "contains(text, 'METRIC:function_stats')"),
    "format_errors": (None, "contains(text, 'METRIC:format_error')"),
    "unexpected_errors": (None, "contains(text, 'METRIC:unexpected_error')"),
    "events_by_collection": (
        None,
        "text RLIKE 'METRIC:change_stream_event|METRIC:gcs_write_success' "
        "AND text RLIKE '(customers|leads|changelogs|sysusers|users-metadata)'",
    ),
    "high_latency_operations": (
        None,
        "contains(text, 'latency') AND text RLIKE '[1-9][0-9]{3,}[.][0-9]ms'",
    ),
    "data_loss_events": (
        None,
        "contains(text, 'DATA LOSS') OR contains(text, 'Message dropped') "
        "OR contains(text, 'Failed to send to DLQ')",
    ),
    "writer_errors": (WRITER, "severity IN ('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY')"),
}


def predicate(counter: str, services: dict[str, str] | None = None) -> str:
    """SQL predicate of a counter; ``services`` maps ingestor/writer to deployed names."""
    service, text = COUNTERS[counter]
    if service is None:
        return f"({text})"
    name = (services or {}).get(service, service)
    return f"(service = '{name}' AND ({text}))"


def _counts(counters: list[str], services: dict[str, str] | None) -> list:
    return [
        F.expr(f"count_if({predicate(name, services)})").alias(name) for name in counters
    ]


def counter_totals(log: DataFrame, services: dict[str, str] | None = None) -> DataFrame:
    """One row with every counter."""
    return log.agg(*_counts(list(COUNTERS), services))


def counters_per_period(
    log: DataFrame,
    seconds: int,
    counters: list[str] | None = None,
    services: dict[str, str] | None = None,
    also: tuple = (),
) -> DataFrame:
    """Counters per fixed period (``period_start``); tasks send one partial row per period.

    ``also`` adds further aggregates to the same pass.
    """
    start = F.window("ts", f"{seconds} seconds")["start"]
    return log.groupBy(start.alias("period_start")).agg(
        *_counts(counters or list(COUNTERS), services), *also
    )


def aligned(
    log: DataFrame,
    counter: str,
    seconds: int,
    aligner: str,
    services: dict[str, str] | None = None,
) -> DataFrame:
    """A counter as DELTA (count per period) or RATE (count per second of the period)."""
    matching = log.filter(predicate(counter, services))
    counted = matching.groupBy(
        F.window("ts", f"{seconds} seconds")["start"].alias("period_start")
    ).agg(F.count(F.lit(1)).alias("n"))
    value = F.col("n").cast("double") if aligner == "DELTA" else F.col("n") / F.lit(float(seconds))
    return counted.select("period_start", value.alias("value"))
