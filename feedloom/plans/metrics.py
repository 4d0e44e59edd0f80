"""Pipeline metrics as aggregations over the metric log and the change feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.envelope import KEPT_OPERATIONS
from ..operators.grouping import ordered_blocks

# Limits behind the flags.
LATENCY_SAMPLE = 1000
BACKPRESSURE_DEPTH = 8000
CRITICAL_STREAK = 10
BREAKER_STREAK = 5
BREAKER_WINDOW_SECONDS = 300
BREAKER_LIMIT = 100
SLOW_LIMITS_MS = {"pubsub_published": 1000.0, "gcs_write_success": 2000.0, "checkpoint_save": 1000.0}
SNAPSHOT_EVERY = 100
ALL = "ALL"


def named(log: DataFrame) -> DataFrame:
    """Adds ``name`` (the metric), ``collection``, ``operation`` and ``error_type``."""
    label = lambda key: F.try_element_at("labels", F.lit(key))
    return log.select(
        "*",
        F.regexp_extract("text", "METRIC:([a-z_]*)", 1).alias("name"),
        label("collection").alias("collection"),
        label("operation").alias("operation"),
        label("error_type").alias("error_type"),
    )


def _is(name: str) -> Column:
    return F.col("name") == name


def operations_by_collection(changes: DataFrame) -> DataFrame:
    """Collection x operation counts with a total column."""
    counts = [
        F.count_if(F.col("operation") == op).alias(op) for op in KEPT_OPERATIONS
    ]
    return changes.groupBy("collection").agg(*counts, F.count(F.lit(1)).alias("total"))


def event_counts(changes: DataFrame) -> DataFrame:
    """Counts per (collection, operation), per collection, per operation and overall, in one pass."""
    pairs = changes.groupBy("collection", "operation").agg(F.count(F.lit(1)).alias("n"))
    level = F.array(
        F.struct(F.col("collection").alias("c"), F.col("operation").alias("o")),
        F.struct(F.col("collection").alias("c"), F.lit(ALL).alias("o")),
        F.struct(F.lit(ALL).alias("c"), F.col("operation").alias("o")),
        F.struct(F.lit(ALL).alias("c"), F.lit(ALL).alias("o")),
    )
    # The four levels are built from the pair counts, not from four copies of every event.
    return (
        pairs.select(F.explode(level).alias("level"), "n")
        .groupBy(F.col("level.c").alias("collection"), F.col("level.o").alias("operation"))
        .agg(F.sum("n").alias("n"))
    )


def publish_outcomes(log: DataFrame) -> DataFrame:
    """Published, failed and dead-lettered per collection and overall, with the success rate.

    Without any attempt the success rate is 1.
    """
    per = (
        named(log)
        .groupBy("collection")
        .agg(
            F.count_if(_is("pubsub_published")).alias("published"),
            F.count_if(_is("publish_failed")).alias("failed"),
            F.count_if(_is("dead_letter")).alias("dead_lettered"),
        )
    )
    both = per.select(
        F.explode(F.array(F.coalesce("collection", F.lit("unknown")), F.lit(ALL))).alias("collection"),
        "published",
        "failed",
        "dead_lettered",
    )
    summed = both.groupBy("collection").agg(
        *[F.sum(c).alias(c) for c in ("published", "failed", "dead_lettered")]
    )
    return summed.withColumn("success_rate", success_rate(F.col("published"), F.col("failed")))


def success_rate(published: Column, failed: Column) -> Column:
    return F.coalesce(F.try_divide(published, published + failed), F.lit(1.0))


WRITE_FAILURES = ("gcs_write_failed", "format_error", "unexpected_error")


def writer_summary(log: DataFrame) -> DataFrame:
    """One-row summary of the raw writer; the success share is 0 when nothing was processed."""
    done = _is("gcs_write_success")
    failed = F.col("name").isin(*WRITE_FAILURES)
    totals = named(log).agg(
        F.count_if(done | failed).alias("total_processed"),
        F.count_if(done).alias("total_succeeded"),
        F.count_if(failed).alias("total_failed"),
        F.avg(F.when(done, F.col("payload.latency_ms"))).alias("avg_latency_ms"),
        F.avg(F.when(done, F.col("payload.write_ms"))).alias("avg_write_latency_ms"),
        F.coalesce(F.sum(F.when(done, F.col("payload.size_bytes"))), F.lit(0)).alias("total_bytes"),
        ((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6).alias("elapsed_seconds"),
    )
    return totals.select(
        "*",
        F.coalesce(F.try_divide(F.col("total_succeeded") * 100.0, F.col("total_processed")), F.lit(0.0)).alias("success_pct"),
        F.coalesce(F.try_divide(F.col("total_processed"), F.col("elapsed_seconds")), F.lit(0.0)).alias("messages_per_second"),
        F.coalesce(F.try_divide(F.col("total_bytes"), F.col("elapsed_seconds")), F.lit(0.0)).alias("bytes_per_second"),
    )


def writer_breakdown(log: DataFrame) -> DataFrame:
    """Writer counts by collection, by operation and by error type, as (dimension, key, n)."""
    done = _is("gcs_write_success")
    failed = F.col("name").isin(*WRITE_FAILURES)
    counted = (
        named(log)
        .filter(done | failed)
        .groupBy("collection", "operation", "name")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    keys = F.array(
        F.struct(F.lit("collection").alias("dimension"), F.coalesce("collection", F.lit("unknown")).alias("key")),
        F.when(done, F.struct(F.lit("operation").alias("dimension"), F.coalesce("operation", F.lit("unknown")).alias("key"))),
        F.when(failed, F.struct(F.lit("error").alias("dimension"), F.col("name").alias("key"))),
    )
    return (
        counted.select(F.explode(keys).alias("k"), "n")
        .filter("k IS NOT NULL")
        .groupBy("k.dimension", "k.key")
        .agg(F.sum("n").alias("n"))
    )


def error_counts(log: DataFrame) -> DataFrame:
    return (
        named(log)
        .filter(F.col("error_type").isNotNull())
        .groupBy("error_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def recent_latencies(log: DataFrame, name: str, sample: int = LATENCY_SAMPLE) -> DataFrame:
    """The last ``sample`` latencies of a metric: per-task top rows, merged (never a full sort)."""
    return (
        named(log)
        .filter(_is(name))
        .select("ts", "seq", F.col("payload.latency_ms").alias("latency_ms"))
        .orderBy(F.desc("ts"), F.desc("seq"))
        .limit(sample)
    )


def latency_percentiles(log: DataFrame, name: str = "pubsub_published", sample: int = LATENCY_SAMPLE) -> DataFrame:
    """p50/p95/p99 as the sorted sample's element at floor(n * q); 0 without a sample.

    The sample holds at most ``sample`` values, so its array is bounded.
    """
    values = F.sort_array(F.collect_list("latency_ms"))
    row = recent_latencies(log, name, sample).agg(values.alias("v"), F.count(F.lit(1)).alias("n"))

    def at(q: float) -> Column:
        return F.coalesce(F.get("v", F.floor(F.col("n") * q).cast("int")), F.lit(0.0))

    return row.select(
        "n", at(0.5).alias("p50_ms"), at(0.95).alias("p95_ms"), at(0.99).alias("p99_ms")
    )


def oplog_lag(events: DataFrame, seconds: int = 300) -> DataFrame:
    """Greatest and latest lag (ingest time minus cluster time) per period."""
    lag = (F.unix_micros("ingested_at") - F.unix_micros("cluster_time")) / 1e6
    return events.groupBy(
        F.window("ingested_at", f"{seconds} seconds")["start"].alias("period_start")
    ).agg(
        F.max(lag).alias("max_lag_seconds"),
        F.max_by(lag, F.struct("ingested_at", "seq")).alias("last_lag_seconds"),
    )


def service_status(log: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """One row: uptime, counts, success rate, deepest queue, distinct collections, last checkpoint."""
    counts = named(log).agg(
        ((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6).alias("uptime_seconds"),
        F.count_if(_is("change_stream_event")).alias("events_processed"),
        F.count_if(_is("pubsub_published")).alias("events_published"),
        F.count_if(_is("publish_failed")).alias("events_failed"),
        F.max_by("payload.queue_depth", F.struct("ts", "seq")).alias("queue_depth"),
        F.count_if(F.col("payload.queue_depth") > BACKPRESSURE_DEPTH).alias("backpressure_events"),
        F.count_distinct("collection").alias("collections_processed"),
    )
    last = checkpoints.agg(F.max("ts").alias("last_checkpoint"))
    rate = success_rate(F.col("events_published"), F.col("events_failed"))
    # Both sides are single aggregated rows.
    return counts.join(F.broadcast(last), F.lit(True)).withColumn("success_rate", rate)


def final_summary(log: DataFrame) -> DataFrame:
    counted = named(log).agg(
        ((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6).alias("total_runtime_seconds"),
        F.count_if(_is("change_stream_event")).alias("total_processed"),
        F.count_if(_is("pubsub_published")).alias("total_published"),
        F.count_if(_is("publish_failed")).alias("total_failed"),
        F.count_distinct(F.when(_is("change_stream_event"), F.col("collection"))).alias("collections_processed"),
    )
    return counted.withColumn(
        "final_success_rate", success_rate(F.col("total_published"), F.col("total_failed"))
    )


# Exported series and their kinds.
EXPORTED = {
    "events_processed": "GAUGE",
    "events_per_second": "GAUGE",
    "success_rate": "GAUGE",
    "oplog_lag": "GAUGE",
    "queue_depth": "GAUGE",
    "dlq_messages": "CUMULATIVE",
}


def metric_series(log: DataFrame, lags: DataFrame, service: str, database: str) -> DataFrame:
    """The six exported series as long rows (metric, kind, start, end, value, labels).

    Gauges carry only their end time, the cumulative series also its start.
    """
    counted = named(log).agg(
        F.min("ts").alias("start"),
        F.max("ts").alias("end"),
        F.count_if(_is("change_stream_event")).cast("double").alias("events_processed"),
        success_rate(F.count_if(_is("pubsub_published")), F.count_if(_is("publish_failed"))).alias("success_rate"),
        F.max_by("payload.queue_depth", F.struct("ts", "seq")).cast("double").alias("queue_depth"),
        F.count_if(_is("dead_letter")).cast("double").alias("dlq_messages"),
    )
    seconds = (F.unix_micros("end") - F.unix_micros("start")) / 1e6
    lag = lags.agg(F.max_by("last_lag_seconds", "period_start").alias("oplog_lag"))
    wide = counted.join(F.broadcast(lag), F.lit(True)).withColumn(
        "events_per_second", F.coalesce(F.try_divide(F.col("events_processed"), seconds), F.lit(0.0))
    )
    long = wide.unpivot(["start", "end"], list(EXPORTED), "metric", "value")
    kind = F.create_map(*[F.lit(x) for pair in EXPORTED.items() for x in pair])
    return long.select(
        "metric",
        F.try_element_at(kind, F.col("metric")).alias("kind"),
        F.when(F.try_element_at(kind, F.col("metric")) == "CUMULATIVE", F.col("start")).alias("start"),
        "end",
        "value",
        F.create_map(F.lit("service"), F.lit(service), F.lit("database"), F.lit(database)).alias("labels"),
    )


def checkpoint_stats(checkpoints: DataFrame, last: int = 10) -> DataFrame:
    """Saves, failures, success share, mean of the last saves, maximum and total duration."""
    totals = checkpoints.agg(
        F.count_if("ok").alias("total_saves"),
        F.count_if(~F.col("ok")).alias("failed_saves"),
        F.max("ts").alias("last_checkpoint"),
        F.max_by("save_ms", F.when(F.col("ok"), F.struct("ts", "checkpoint_id"))).alias("last_save_ms"),
        F.max(F.when(F.col("ok"), F.col("save_ms"))).alias("max_save_ms"),
        F.sum(F.when(F.col("ok"), F.col("save_ms"))).alias("total_save_ms"),
    )
    recent = (
        checkpoints.filter("ok")
        .orderBy(F.desc("ts"), F.desc("checkpoint_id"))
        .limit(last)
        .agg(F.coalesce(F.avg("save_ms"), F.lit(0.0)).alias("avg_save_ms"))
    )
    share = F.coalesce(
        F.try_divide(F.col("total_saves") * 100.0, F.col("total_saves") + F.col("failed_saves")),
        F.lit(100.0),
    )
    return totals.join(F.broadcast(recent), F.lit(True)).withColumn("success_pct", share)


def breaker_windows(
    log: DataFrame, seconds: int = BREAKER_WINDOW_SECONDS, limit: int = BREAKER_LIMIT
) -> DataFrame:
    """Dead letters per period and whether the circuit breaker would open."""
    dead = named(log).filter(_is("dead_letter"))
    counted = dead.groupBy(F.window("ts", f"{seconds} seconds")["start"].alias("period_start")).agg(
        F.count(F.lit(1)).alias("dead_letters")
    )
    return counted.withColumn("breaker_open", F.col("dead_letters") > limit)


def streaks(rows: DataFrame, counts: Column, resets: Column) -> DataFrame:
    """Runs of counted rows between resets, in (ts, seq) order.

    A run's number is the count of resets before it.  Rows are range-partitioned into ordered
    blocks; a running sum inside each block plus the sums of the blocks before it gives that
    count without ever sorting all rows in one task.  The block table has one row per
    partition, so it is safe to broadcast.
    """
    marked = rows.select("ts", "seq", counts.alias("counts"), resets.alias("resets")).filter("counts OR resets")
    blocks = ordered_blocks(marked, "ts", "seq")
    offsets = block_offsets(blocks, {"before": F.count_if("resets")})
    inside = W.partitionBy("_block").orderBy("ts", "seq").rowsBetween(W.unboundedPreceding, 0)
    numbered = blocks.withColumn("_in", F.count_if("resets").over(inside)).join(
        F.broadcast(offsets), "_block"
    )
    return (
        numbered.filter("counts")
        .groupBy((F.col("_in") + F.col("before")).alias("run"))
        .agg(
            F.min_by("seq", F.struct("ts", "seq")).alias("first_seq"),
            F.min("ts").alias("started_at"),
            F.count(F.lit(1)).alias("length"),
        )
    )


def block_offsets(blocks: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """For each block, the sums over all earlier blocks (one row per block)."""
    per_block = blocks.groupBy("_block").agg(*[c.alias(n) for n, c in sums.items()])
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    return per_block.select(
        "_block", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in sums]
    )


ERROR_NAMES = ("publish_failed", "format_error", "unexpected_error", "gcs_write_failed")
SUCCESS_NAMES = ("pubsub_published", "change_stream_event", "gcs_write_success")


def error_streaks(log: DataFrame) -> DataFrame:
    """Consecutive errors, reset by any success, with the critical and breaker flags."""
    found = streaks(named(log), F.col("name").isin(*ERROR_NAMES), F.col("name").isin(*SUCCESS_NAMES))
    return found.select(
        "first_seq",
        "started_at",
        "length",
        (F.col("length") > CRITICAL_STREAK).alias("is_critical"),
        (F.col("length") > BREAKER_STREAK).alias("opens_breaker"),
    )


def dead_letter_streaks(log: DataFrame) -> DataFrame:
    """Consecutive dead letters, reset by a successful publish."""
    return streaks(named(log), _is("dead_letter"), _is("pubsub_published")).select(
        "first_seq", "started_at", "length"
    )


def backpressure_count(log: DataFrame, depth: int = BACKPRESSURE_DEPTH) -> DataFrame:
    return log.agg(F.count_if(F.col("payload.queue_depth") > depth).alias("backpressure_events"))


def slow_operations(log: DataFrame, limits: dict[str, float] = SLOW_LIMITS_MS) -> DataFrame:
    """Operations seen and those slower than their limit, per operation kind."""
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    rows = named(log).filter(F.col("name").isin(*limits))
    slow = F.col("payload.latency_ms") > F.try_element_at(limit, F.col("name"))
    return rows.groupBy("name").agg(
        F.count(F.lit(1)).alias("operations"), F.count_if(slow).alias("slow_operations")
    )


def stage_reconciliation(log: DataFrame, as_of: dt.datetime, minutes: int = 10) -> DataFrame:
    """Ingested, published and stored within the lookback, and whether data is flowing."""
    recent = log.filter(F.col("ts") >= F.lit(as_of - dt.timedelta(minutes=minutes)))
    counted = recent.agg(
        F.count_if(F.col("text").contains("METRIC:change_stream_event")).alias("ingested"),
        F.count_if(F.col("text").contains("METRIC:pubsub_published")).alias("published"),
        F.count_if(F.col("text").contains("METRIC:gcs_write_success")).alias("stored"),
    )
    return counted.withColumn("flowing", F.col("ingested") > 0)


def recent_failures(log: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Errors within the last hour and data-loss lines within the last day."""
    day = log.filter(F.col("ts") >= F.lit(as_of - dt.timedelta(hours=24)))
    hour = F.col("ts") >= F.lit(as_of - dt.timedelta(hours=1))
    severe = F.col("severity").isin("ERROR", "CRITICAL", "ALERT", "EMERGENCY")
    return day.agg(
        F.count_if(hour & severe).alias("errors_last_hour"),
        F.count_if(F.col("text").contains("DATA LOSS")).alias("data_loss_last_day"),
    )


def lines_per_metric(log: DataFrame) -> DataFrame:
    """Log lines per metric name."""
    name = F.regexp_extract("text", "METRIC:[a-z_]*", 0)
    return (
        log.select(name.alias("metric")).filter("metric <> ''").groupBy("metric").agg(F.count(F.lit(1)).alias("n"))
    )


def interval_rates(log: DataFrame, name: str, seconds: int = 60, keep: int = 60) -> DataFrame:
    """Per reporting tick: events per second since the last tick and the mean of the last rates.

    Ticks form an unbroken grid from the first to the last event.  Events are counted per tick
    first; each tick's count is then handed to the ``keep`` ticks whose mean it enters, so no
    window runs over all ticks in one task.
    """
    spark = log.sparkSession
    events = named(log).filter(_is(name))
    epoch = F.unix_seconds("ts")
    counted = events.groupBy((epoch - F.pmod(epoch, F.lit(seconds))).alias("tick")).agg(
        F.count(F.lit(1)).alias("n")
    )
    bounds = counted.agg(F.min("tick").alias("lo"), F.max("tick").alias("hi")).first()
    if bounds["lo"] is None:
        return counted.selectExpr("timestamp_seconds(tick) AS tick", "0D AS rate", "0D AS mean_rate").limit(0)
    low, high = bounds["lo"], bounds["hi"]
    grid = spark.range(low, high + seconds, seconds).withColumnRenamed("id", "tick")
    reach = F.sequence(F.col("tick"), F.col("tick") + (keep - 1) * seconds, F.lit(seconds))
    carried = (
        counted.select(F.explode(reach).alias("tick"), "n")
        .groupBy("tick")
        .agg(F.sum("n").alias("recent"))
    )
    seen = F.least(F.lit(keep), (F.col("tick") - low) / seconds + 1)
    return (
        grid.join(counted, "tick", "left")
        .join(carried, "tick", "left")
        .select(
            F.timestamp_seconds("tick").alias("tick"),
            (F.coalesce("n", F.lit(0)) / seconds).alias("rate"),
            (F.coalesce("recent", F.lit(0)) / seconds / seen).alias("mean_rate"),
        )
    )


def running_snapshots(log: DataFrame, every: int = SNAPSHOT_EVERY) -> DataFrame:
    """Cumulative writer counts after every ``every``-th processed message, in (ts, seq) order."""
    outcomes = named(log).filter(F.col("name").isin("gcs_write_success", *WRITE_FAILURES))
    rows = outcomes.select(
        "ts",
        "seq",
        _is("gcs_write_success").alias("ok"),
        F.coalesce("payload.size_bytes", F.lit(0)).alias("bytes"),
    )
    blocks = ordered_blocks(rows, "ts", "seq")
    sums = {
        "processed": F.count(F.lit(1)),
        "succeeded": F.count_if("ok"),
        "total_bytes": F.sum("bytes"),
    }
    offsets = block_offsets(blocks, sums).selectExpr(
        "_block", *[f"{n} AS {n}_before" for n in sums]
    )
    inside = W.partitionBy("_block").orderBy("ts", "seq").rowsBetween(W.unboundedPreceding, 0)
    running = blocks.select("*", *[c.over(inside).alias(n) for n, c in sums.items()]).join(
        F.broadcast(offsets), "_block"
    )
    total = running.select(
        "seq", *[(F.col(n) + F.col(f"{n}_before")).alias(n) for n in sums]
    )
    return total.filter(F.col("processed") % every == 0)
