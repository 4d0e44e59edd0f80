"""The four dashboards: every chart's counter, aligner and period, answered in one pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counters import counters_per_period

# Fixed values: (counter, aligner, period in seconds) per chart, in dashboard order.
DASHBOARDS: dict[str, list[tuple[str, str, int]]] = {
    "operational": [
        ("change_stream_events", "RATE", 60),
        ("pubsub_published", "RATE", 60),
        ("gcs_write_success", "RATE", 60),
        ("data_loss_events", "DELTA", 3600),
        ("change_stream_events", "DELTA", 86400),
        ("format_errors", "RATE", 60),
        ("unexpected_errors", "RATE", 60),
        ("slow_publishes", "RATE", 300),
        ("function_messages_received", "RATE", 300),
    ],
    "executive": [
        ("change_stream_events", "DELTA", 86400),
        ("data_loss_events", "DELTA", 3600),
        ("change_stream_events", "RATE", 300),
        ("pubsub_published", "RATE", 300),
        ("gcs_write_success", "RATE", 300),
        ("format_errors", "RATE", 300),
        ("unexpected_errors", "RATE", 300),
        ("gcs_write_failed", "RATE", 300),
        ("slow_publishes", "RATE", 300),
        ("high_latency_operations", "RATE", 300),
        ("events_by_collection", "RATE", 300),
        ("function_messages_received", "RATE", 300),
    ],
    "business_analyst": [
        ("events_by_collection", "RATE", 300),
        ("change_stream_events", "RATE", 60),
        ("pubsub_published", "DELTA", 300),
        ("gcs_write_success", "DELTA", 300),
        ("format_errors", "RATE", 60),
        ("unexpected_errors", "RATE", 60),
        ("slow_publishes", "RATE", 300),
        ("high_latency_operations", "RATE", 300),
        ("ingestor_system_stats", "RATE", 300),
        ("function_stats", "RATE", 300),
    ],
    "data_insights": [
        ("events_by_collection", "RATE", 300),
        ("change_stream_events", "DELTA", 3600),
        ("pubsub_published", "DELTA", 3600),
        ("gcs_write_success", "DELTA", 3600),
        ("high_latency_operations", "RATE", 300),
        ("ingestor_system_stats", "RATE", 300),
    ],
}
BASE_PERIOD = 60
# Fixed value: charts of this counter turn red at the threshold.
THRESHOLDS = {"data_loss_events": 1.0}


def dashboard(
    log: DataFrame, name: str, services: dict[str, str] | None = None
) -> DataFrame:
    """Every chart of a dashboard as (chart, counter, aligner, period_seconds, period_start, value, over_threshold).

    The log is scanned and shuffled once, into per-minute counts; the charts' longer periods
    are multiples of a minute and are summed from those rows.  Periods without a count are
    left out, as in a sparse counter series.
    """
    charts = DASHBOARDS[name]
    counters = sorted({c for c, _, _ in charts})
    minutes = counters_per_period(log, BASE_PERIOD, counters, services)
    series = F.array(
        *[
            F.struct(
                F.lit(i).alias("chart"),
                F.lit(counter).alias("counter"),
                F.lit(aligner).alias("aligner"),
                F.lit(seconds).alias("period_seconds"),
                F.col(counter).alias("n"),
            )
            for i, (counter, aligner, seconds) in enumerate(charts)
        ]
    )
    rows = minutes.select("period_start", F.explode(series).alias("c")).filter("c.n > 0")
    epoch = F.unix_seconds("period_start")
    start = F.timestamp_seconds(epoch - F.pmod(epoch, F.col("c.period_seconds")))
    summed = rows.groupBy(
        "c.chart", "c.counter", "c.aligner", "c.period_seconds", start.alias("period_start")
    ).agg(F.sum("c.n").alias("n"))
    value = F.when(F.col("aligner") == "DELTA", F.col("n").cast("double")).otherwise(
        F.col("n") / F.col("period_seconds")
    )
    limits = F.coalesce(
        *[F.when(F.col("counter") == c, value >= limit) for c, limit in THRESHOLDS.items()],
        F.lit(False),
    )
    return summed.select(
        "chart",
        "counter",
        "aligner",
        "period_seconds",
        "period_start",
        value.alias("value"),
        limits.alias("over_threshold"),
    )
