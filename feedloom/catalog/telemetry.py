"""Metric, counter, dashboard, alert and replay queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import alerts as A
from ..plans import counters as C
from ..plans import metrics as M
from ..plans import replay as R
from ..plans.dashboards import DASHBOARDS, THRESHOLDS, dashboard
from ..session import prepare, table
from . import feeds

AS_OF = dt.datetime(2024, 1, 20, 12, 0, 0)
AS_OF_SQL = "TIMESTAMP '2024-01-20 12:00:00'"
LOG = f"log AS ({feeds.bare(feeds.LOG_SQL)})"
CHECKPOINTS = f"checkpoints AS ({feeds.bare(feeds.CHECKPOINT_SQL)})"
CHANGES = f"changes AS (SELECT {feeds.OPERATION} AS operation, {feeds.COLLECTION} AS collection FROM events)"


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {f.name: F.round(f.name, digits) for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.withColumns(doubles) if doubles else df


def _on_log(plan):
    return lambda spark, sf_dir: _round(plan(feeds.metric_log(prepare(spark), sf_dir)))


def _on_checkpoints(plan):
    return lambda spark, sf_dir: _round(plan(feeds.checkpoints(prepare(spark), sf_dir)))


def _on_changes(plan):
    def run(spark, sf_dir):
        changes = feeds.change_events(prepare(spark), sf_dir)
        return plan(changes.selectExpr("operationType AS operation", "ns.coll AS collection"))

    return run


QUERIES: dict = {}


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


# --- counts over the change feed ----------------------------------------------------------

_OPS = ("insert", "update", "delete", "replace")
QUERIES["operations_by_collection"] = (
    _on_changes(M.operations_by_collection),
    _with(CHANGES, "SELECT collection, " + ", ".join(f"count(*) FILTER (operation = '{o}') AS \"{o}\"" for o in _OPS)
          + ", count(*) AS total FROM changes GROUP BY collection"),
)
QUERIES["event_counts_all_levels"] = (
    _on_changes(M.event_counts),
    _with(CHANGES, "SELECT coalesce(collection, 'ALL') AS collection, coalesce(operation, 'ALL') AS operation, CAST(count(*) AS BIGINT) AS n "
          "FROM changes GROUP BY GROUPING SETS ((collection, operation), (collection), (operation), ())"),
)

# --- publish, writer, errors, latency -----------------------------------------------------

QUERIES["publish_outcomes"] = (
    _on_log(M.publish_outcomes),
    _with(LOG + ", per AS (SELECT coalesce(collection, 'ALL') AS collection, count(*) FILTER (name = 'pubsub_published') AS published, "
          "count(*) FILTER (name = 'publish_failed') AS failed, count(*) FILTER (name = 'dead_letter') AS dead_lettered "
          "FROM log GROUP BY GROUPING SETS ((collection), ()))",
          "SELECT *, round(CASE WHEN published + failed = 0 THEN 1.0 ELSE published / (published + failed) END, 6) AS success_rate FROM per"),
)
_DONE = "name = 'gcs_write_success'"
_FAILED = "name IN ('gcs_write_failed', 'format_error', 'unexpected_error')"
QUERIES["writer_summary"] = (
    _on_log(M.writer_summary),
    _with(LOG + f", t AS (SELECT count(*) FILTER ({_DONE} OR {_FAILED}) AS total_processed, count(*) FILTER ({_DONE}) AS total_succeeded, "
          f"count(*) FILTER ({_FAILED}) AS total_failed, round(avg(latency_ms) FILTER ({_DONE}), 6) AS avg_latency_ms, "
          f"round(avg(write_ms) FILTER ({_DONE}), 6) AS avg_write_latency_ms, CAST(sum(size_bytes) FILTER ({_DONE}) AS BIGINT) AS total_bytes, "
          "(epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS elapsed_seconds FROM log)",
          "SELECT total_processed, total_succeeded, total_failed, avg_latency_ms, avg_write_latency_ms, total_bytes, "
          "round(elapsed_seconds, 6) AS elapsed_seconds, round(total_succeeded * 100.0 / total_processed, 6) AS success_pct, "
          "round(total_processed / elapsed_seconds, 6) AS messages_per_second, round(total_bytes / elapsed_seconds, 6) AS bytes_per_second FROM t"),
)
QUERIES["writer_breakdown"] = (
    _on_log(M.writer_breakdown),
    _with(LOG, f"SELECT 'collection' AS dimension, collection AS key, count(*) AS n FROM log WHERE {_DONE} OR {_FAILED} GROUP BY 2 "
          f"UNION ALL SELECT 'operation', operation, count(*) FROM log WHERE {_DONE} GROUP BY 2 "
          f"UNION ALL SELECT 'error', name, count(*) FROM log WHERE {_FAILED} GROUP BY 2"),
)
QUERIES["error_counts_by_type"] = (
    _on_log(M.error_counts),
    _with(LOG, "SELECT error_type, count(*) AS n FROM log WHERE error_type IS NOT NULL GROUP BY 1"),
)
_SAMPLE = "s AS (SELECT ts, seq, latency_ms FROM log WHERE name = 'pubsub_published' ORDER BY ts DESC, seq DESC LIMIT 1000)"
QUERIES["recent_latency_sample"] = (
    _on_log(lambda log: M.recent_latencies(log, "pubsub_published")),
    _with(f"{LOG}, {_SAMPLE}", "SELECT ts, seq, round(latency_ms, 6) AS latency_ms FROM s"),
)
QUERIES["latency_percentiles"] = (
    _on_log(M.latency_percentiles),
    _with(f"{LOG}, {_SAMPLE}, o AS (SELECT list(latency_ms ORDER BY latency_ms) AS v, count(*) AS n FROM s)",
          "SELECT n, round(v[1 + CAST(floor(n * 0.5) AS INT)], 6) AS p50_ms, round(v[1 + CAST(floor(n * 0.95) AS INT)], 6) AS p95_ms, "
          "round(v[1 + CAST(floor(n * 0.99) AS INT)], 6) AS p99_ms FROM o"),
)
_BUCKET = "to_timestamp(CAST(epoch({0}) // {1} * {1} AS BIGINT))::TIMESTAMP"


def _bucket(time: str, seconds: int) -> str:
    return f"time_bucket(INTERVAL '{seconds} seconds', {time}, TIMESTAMP '2000-01-01 00:00:00')"


QUERIES["oplog_lag_per_period"] = (
    lambda spark, sf_dir: _round(M.oplog_lag(feeds.lag_events(prepare(spark), sf_dir))),
    "WITH e AS (SELECT event_id AS seq, ts, ts + to_milliseconds(CAST(round(value * 100) * 10 AS BIGINT)) AS ingested_at FROM events) "
    f"SELECT {_bucket('ingested_at', 300)} AS period_start, round(max((epoch_us(ingested_at) - epoch_us(ts)) / 1e6), 6) AS max_lag_seconds, "
    "round(arg_max((epoch_us(ingested_at) - epoch_us(ts)) / 1e6, struct_pack(a := ingested_at, b := seq)), 6) AS last_lag_seconds FROM e GROUP BY 1",
)
_STATUS = (
    "(epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6", "count(*) FILTER (name = 'change_stream_event')",
    "count(*) FILTER (name = 'pubsub_published')", "count(*) FILTER (name = 'publish_failed')",
)
QUERIES["service_status"] = (
    lambda spark, sf_dir: _round(M.service_status(feeds.metric_log(prepare(spark), sf_dir), feeds.checkpoints(spark, sf_dir))),
    _with(f"{LOG}, {CHECKPOINTS}, t AS (SELECT round({_STATUS[0]}, 6) AS uptime_seconds, {_STATUS[1]} AS events_processed, "
          f"{_STATUS[2]} AS events_published, {_STATUS[3]} AS events_failed, arg_max(queue_depth, struct_pack(a := ts, b := seq)) AS queue_depth, "
          "count(*) FILTER (queue_depth > 8000) AS backpressure_events, count(DISTINCT collection) AS collections_processed FROM log)",
          "SELECT t.*, (SELECT max(ts) FROM checkpoints) AS last_checkpoint, round(events_published / (events_published + events_failed), 6) AS success_rate FROM t"),
)
QUERIES["final_summary"] = (
    _on_log(M.final_summary),
    _with(LOG + f", t AS (SELECT round({_STATUS[0]}, 6) AS total_runtime_seconds, {_STATUS[1]} AS total_processed, {_STATUS[2]} AS total_published, "
          f"{_STATUS[3]} AS total_failed, count(DISTINCT collection) FILTER (name = 'change_stream_event') AS collections_processed FROM log)",
          "SELECT *, round(total_published / (total_published + total_failed), 6) AS final_success_rate FROM t"),
)


def _series(spark, sf_dir):
    log = feeds.metric_log(prepare(spark), sf_dir)
    lags = M.oplog_lag(feeds.lag_events(spark, sf_dir))
    rows = M.metric_series(log, lags, "change-ingestor", "shop")
    return _round(rows.selectExpr("metric", "kind", "start", "end", "value", "labels['service'] AS service", "labels['database'] AS database"))


QUERIES["metric_series_export"] = (
    _series,
    _with(f"{LOG}, t AS (SELECT min(ts) AS a, max(ts) AS b, CAST({_STATUS[1]} AS DOUBLE) AS processed, "
          f"{_STATUS[2]} / ({_STATUS[2]} + {_STATUS[3]}) AS rate, CAST(arg_max(queue_depth, struct_pack(a := ts, b := seq)) AS DOUBLE) AS depth, "
          "CAST(count(*) FILTER (name = 'dead_letter') AS DOUBLE) AS dead FROM log), "
          "g AS (SELECT arg_max((epoch_us(i) - epoch_us(ts)) / 1e6, struct_pack(a := i, b := event_id)) AS lag "
          "FROM (SELECT *, ts + to_milliseconds(CAST(round(value * 100) * 10 AS BIGINT)) AS i FROM events)), "
          "l AS (SELECT 'events_processed' AS metric, 'GAUGE' AS kind, CAST(NULL AS TIMESTAMP) AS start, b AS \"end\", processed AS value FROM t "
          "UNION ALL SELECT 'events_per_second', 'GAUGE', NULL, b, processed / ((epoch_us(b) - epoch_us(a)) / 1e6) FROM t "
          "UNION ALL SELECT 'success_rate', 'GAUGE', NULL, b, rate FROM t UNION ALL SELECT 'oplog_lag', 'GAUGE', NULL, b, lag FROM t, g "
          "UNION ALL SELECT 'queue_depth', 'GAUGE', NULL, b, depth FROM t UNION ALL SELECT 'dlq_messages', 'CUMULATIVE', a, b, dead FROM t)",
          "SELECT metric, kind, start, \"end\", round(value, 6) AS value, 'change-ingestor' AS service, 'shop' AS database FROM l"),
)
QUERIES["checkpoint_stats"] = (
    _on_checkpoints(M.checkpoint_stats),
    _with(CHECKPOINTS, "SELECT count(*) FILTER (ok) AS total_saves, count(*) FILTER (NOT ok) AS failed_saves, max(ts) AS last_checkpoint, "
          "arg_max(save_ms, struct_pack(a := ts, b := checkpoint_id)) FILTER (ok) AS last_save_ms, max(save_ms) FILTER (ok) AS max_save_ms, "
          "CAST(sum(save_ms) FILTER (ok) AS BIGINT) AS total_save_ms, "
          "(SELECT round(avg(save_ms), 6) FROM (SELECT save_ms FROM checkpoints WHERE ok ORDER BY ts DESC, checkpoint_id DESC LIMIT 10)) AS avg_save_ms, "
          "round(count(*) FILTER (ok) * 100.0 / count(*), 6) AS success_pct FROM checkpoints"),
)
QUERIES["circuit_breaker_windows"] = (
    _on_log(lambda log: M.breaker_windows(log, limit=1)),
    _with(LOG, f"SELECT {_bucket('ts', 300)} AS period_start, count(*) AS dead_letters, count(*) > 1 AS breaker_open FROM log WHERE name = 'dead_letter' GROUP BY 1"),
)


def _streak_sql(counts: str, resets: str, source: str, seq: str = "seq") -> str:
    return (
        f"m AS (SELECT ts, {seq} AS seq, {counts} AS c, {resets} AS r FROM {source}), "
        "n AS (SELECT *, sum(CASE WHEN r THEN 1 ELSE 0 END) OVER (ORDER BY ts, seq) AS run FROM m WHERE c OR r), "
        "s AS (SELECT arg_min(seq, struct_pack(a := ts, b := seq)) AS first_seq, min(ts) AS started_at, count(*) AS length FROM n WHERE c GROUP BY run)"
    )


_ERR = "name IN ('publish_failed', 'format_error', 'unexpected_error', 'gcs_write_failed')"
_OK = "name IN ('pubsub_published', 'change_stream_event', 'gcs_write_success')"
QUERIES["error_streaks"] = (
    _on_log(M.error_streaks),
    _with(f"{LOG}, {_streak_sql(_ERR, _OK, 'log')}", "SELECT *, length > 10 AS is_critical, length > 5 AS opens_breaker FROM s"),
)
_DEAD = "name = 'dead_letter'"
_PUBLISHED = "name = 'pubsub_published'"
QUERIES["dead_letter_streaks"] = (
    _on_log(M.dead_letter_streaks),
    _with(f"{LOG}, {_streak_sql(_DEAD, _PUBLISHED, 'log')}", "SELECT * FROM s"),
)
QUERIES["backpressure_events"] = (
    _on_log(M.backpressure_count),
    _with(LOG, "SELECT count(*) FILTER (queue_depth > 8000) AS backpressure_events FROM log"),
)


def _slow(spark, sf_dir):
    log = feeds.metric_log(prepare(spark), sf_dir)
    saves = feeds.checkpoints(spark, sf_dir).selectExpr(
        "checkpoint_id AS seq", "ts", "'ingestor' AS service", "'INFO' AS severity", "'METRIC:checkpoint_save' AS text",
        "map('collection', CAST(NULL AS string)) AS labels",
        "named_struct('latency_ms', CAST(save_ms * 2 AS double), 'write_ms', 0D, 'size_bytes', 0L, 'queue_depth', 0L) AS payload",
    )
    return M.slow_operations(log.unionByName(saves))


QUERIES["slow_operations"] = (
    _slow,
    _with(f"{LOG}, {CHECKPOINTS}, u AS (SELECT name, latency_ms FROM log UNION ALL SELECT 'checkpoint_save', save_ms * 2 FROM checkpoints), "
          "b AS (SELECT * FROM (VALUES ('pubsub_published', 1000), ('gcs_write_success', 2000), ('checkpoint_save', 1000)) v(name, lim))",
          "SELECT u.name, count(*) AS operations, count(*) FILTER (latency_ms > lim) AS slow_operations FROM u JOIN b ON u.name = b.name GROUP BY 1"),
)
QUERIES["stage_reconciliation"] = (
    _on_log(lambda log: M.stage_reconciliation(log, AS_OF)),
    _with(f"{LOG}, t AS (SELECT count(*) FILTER (name = 'change_stream_event') AS ingested, count(*) FILTER (name = 'pubsub_published') AS published, "
          f"count(*) FILTER (name = 'gcs_write_success') AS stored FROM log WHERE ts >= {AS_OF_SQL} - INTERVAL 10 MINUTE)",
          "SELECT *, ingested > 0 AS flowing FROM t"),
)
QUERIES["recent_failures"] = (
    _on_log(lambda log: M.recent_failures(log, AS_OF)),
    _with(LOG, f"SELECT count(*) FILTER (severity IN ('ERROR', 'CRITICAL') AND ts >= {AS_OF_SQL} - INTERVAL 1 HOUR) AS errors_last_hour, "
          f"count(*) FILTER (contains(text, 'DATA LOSS')) AS data_loss_last_day FROM log WHERE ts >= {AS_OF_SQL} - INTERVAL 24 HOUR"),
)
QUERIES["lines_per_metric"] = (
    _on_log(M.lines_per_metric),
    _with(LOG, "SELECT 'METRIC:' || name AS metric, count(*) AS n FROM log WHERE name <> '' GROUP BY 1"),
)

# --- counters, windows, dashboards --------------------------------------------------------

_DUCK_COUNTERS = {
    "change_stream_events": "name = 'change_stream_event' AND service = 'ingestor'",
    "pubsub_published": "name = 'pubsub_published' AND service = 'ingestor'",
    "pubsub_publish_failed": "name = 'publish_failed' AND service = 'ingestor'",
    "slow_publishes": "name = 'slow_publish' AND service = 'ingestor'",
    "ingestor_system_stats": "name = 'system_stats' AND service = 'ingestor'",
    "function_messages_received": "name = 'message_received' AND service = 'writer'",
    "gcs_write_success": "name = 'gcs_write_success' AND service = 'writer'",
    "gcs_write_failed": "name = 'gcs_write_failed' AND service = 'writer'",
    "function_stats": "name = 'function_stats' AND service = 'writer'",
    "format_errors": "name = 'format_error'",
    "unexpected_errors": "name = 'unexpected_error'",
    "events_by_collection": "name IN ('change_stream_event', 'gcs_write_success') AND collection <> 'telemetry'",
    "high_latency_operations": "name IN ('change_stream_event', 'pubsub_published', 'gcs_write_success') AND latency_ms >= 1000",
    "data_loss_events": "name = ''",
    "writer_errors": "service = 'writer' AND severity IN ('ERROR', 'CRITICAL')",
}
QUERIES["log_counters"] = (
    _on_log(C.counter_totals),
    _with(LOG, "SELECT " + ", ".join(f"count(*) FILTER ({p}) AS {n}" for n, p in _DUCK_COUNTERS.items()) + " FROM log"),
)
for _counter, _seconds, _aligner in (("change_stream_events", 300, "DELTA"), ("events_by_collection", 3600, "DELTA"), ("high_latency_operations", 60, "RATE")):
    QUERIES[f"aligned_{_aligner.lower()}_{_seconds}s"] = (
        _on_log(lambda log, c=_counter, s=_seconds, a=_aligner: C.aligned(log, c, s, a)),
        _with(LOG, f"SELECT {_bucket('ts', _seconds)} AS period_start, round(count(*) / {1.0 if _aligner == 'DELTA' else float(_seconds)}, 6) AS value "
              f"FROM log WHERE {_DUCK_COUNTERS[_counter]} GROUP BY 1"),
    )
QUERIES["interval_rates"] = (
    _on_log(lambda log: M.interval_rates(log, "change_stream_event")),
    _with(f"{LOG}, c AS (SELECT {_bucket('ts', 60)} AS tick, count(*) AS n FROM log WHERE name = 'change_stream_event' GROUP BY 1), "
          "g AS (SELECT unnest(generate_series((SELECT min(tick) FROM c), (SELECT max(tick) FROM c), INTERVAL 60 SECOND)) AS tick), "
          "r AS (SELECT g.tick, coalesce(n, 0) / 60.0 AS rate FROM g LEFT JOIN c ON g.tick = c.tick)",
          "SELECT tick, round(rate, 6) AS rate, round(avg(rate) OVER (ORDER BY tick ROWS BETWEEN 59 PRECEDING AND CURRENT ROW), 6) AS mean_rate FROM r"),
)
QUERIES["running_snapshots"] = (
    _on_log(M.running_snapshots),
    _with(LOG + f", r AS (SELECT seq, count(*) OVER w AS processed, count(*) FILTER ({_DONE}) OVER w AS succeeded, CAST(sum(size_bytes) OVER w AS BIGINT) AS total_bytes "
          f"FROM log WHERE {_DONE} OR {_FAILED} WINDOW w AS (ORDER BY ts, seq ROWS UNBOUNDED PRECEDING))",
          "SELECT * FROM r WHERE processed % 100 = 0"),
)


def _dashboard_sql(name: str) -> str:
    parts = []
    for i, (counter, aligner, seconds) in enumerate(DASHBOARDS[name]):
        value = "CAST(count(*) AS DOUBLE)" if aligner == "DELTA" else f"count(*) / {float(seconds)}"
        over = f"{value} >= {THRESHOLDS[counter]}" if counter in THRESHOLDS else "false"
        parts.append(
            f"SELECT {i} AS chart, '{counter}' AS counter, '{aligner}' AS aligner, {seconds} AS period_seconds, "
            f"{_bucket('ts', seconds)} AS period_start, round({value}, 6) AS value, {over} AS over_threshold "
            f"FROM log WHERE {_DUCK_COUNTERS[counter]} GROUP BY 5"
        )
    return _with(LOG, " UNION ALL ".join(parts))


for _name in DASHBOARDS:
    QUERIES[f"dashboard_{_name}"] = (
        _on_log(lambda log, n=_name: dashboard(log, n)),
        _dashboard_sql(_name),
    )

# --- alerts -------------------------------------------------------------------------------

_PER_MINUTE = (
    "coalesce((SELECT max(n) FROM (SELECT count(*) AS n FROM log WHERE {0} GROUP BY " + _bucket("ts", 60) + ")), 0)"
)
QUERIES["alert_rules"] = (
    _on_log(lambda log: A.log_alerts(log, AS_OF)),
    _with(
        LOG + ", o AS (SELECT 'data_loss' AS rule, CAST(count(*) FILTER (name = '') AS DOUBLE) AS observed, 0.0 AS lim FROM log "
        "UNION ALL SELECT 'format_errors', " + _PER_MINUTE.format(_DUCK_COUNTERS["format_errors"]) + ", 10.0 "
        "UNION ALL SELECT 'unexpected_errors', " + _PER_MINUTE.format(_DUCK_COUNTERS["unexpected_errors"]) + ", 5.0 "
        f"UNION ALL SELECT 'slow_publish_share', count(*) FILTER ({_DUCK_COUNTERS['slow_publishes']}) / count(*) FILTER ({_DUCK_COUNTERS['pubsub_published']}), 0.01 FROM log "
        f"UNION ALL SELECT 'high_latency_share', count(*) FILTER ({_DUCK_COUNTERS['high_latency_operations']}) / count(*) FILTER (contains(text, 'latency')), 0.05 FROM log "
        f"UNION ALL SELECT 'stall', count(*) FILTER (name = 'change_stream_event' AND ts >= {AS_OF_SQL} - INTERVAL 10 MINUTE), 0.0 FROM log)",
        "SELECT rule, round(observed, 6) AS observed, CAST(lim AS DOUBLE) AS \"limit\", CASE WHEN rule = 'stall' THEN observed <= lim "
        "WHEN rule LIKE '%share' THEN observed >= lim ELSE observed > lim END AS firing FROM o",
    ),
)
QUERIES["alert_checkpoint_failures"] = (
    _on_checkpoints(A.checkpoint_alert),
    _with(f"{CHECKPOINTS}, {_streak_sql('NOT ok', 'ok', 'checkpoints', 'checkpoint_id')}",
          "SELECT first_seq AS first_checkpoint, started_at, length AS failures, length >= 3 AS firing FROM s"),
)

# --- replay -------------------------------------------------------------------------------


def _replayed(as_of: dt.datetime, checkpoints: bool = True):
    def run(spark, sf_dir):
        saved = feeds.checkpoints(prepare(spark), sf_dir).filter(F.col("ts") <= F.lit(as_of))
        if not checkpoints:
            saved = saved.filter(F.lit(False))
        point = R.resume_point(saved, as_of)
        # The feed as delivered before the restart and again after it.
        feed = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
        twice = feed.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
        rows = R.replay(twice, point, "ts", "event_id", ["delivery"])
        return rows.select(
            "event_id", "ts", "event_type", F.lit(point.tier).alias("tier"), F.lit(point.suspect).alias("suspect")
        )

    return run


def _replay_sql(as_of: str, saved: bool) -> str:
    now = f"TIMESTAMP '{as_of}'"
    fits = f"token_at IS NOT NULL AND {now} - token_at <= INTERVAL 48 HOUR"
    return _with(
        f"{CHECKPOINTS}, p AS (SELECT max(ts) FILTER (ok) AS token_at, max(ts) AS last_at FROM checkpoints WHERE ts <= {now} AND {str(saved).lower()}), "
        f"q AS (SELECT CASE WHEN {fits} THEN 'checkpoint' WHEN last_at IS NOT NULL THEN 'last_checkpoint' ELSE 'safe_window' END AS tier, "
        f"NOT ({fits} AND {now} - token_at <= INTERVAL 24 HOUR) AS suspect, "
        f"CASE WHEN {fits} THEN token_at WHEN last_at IS NOT NULL THEN last_at - INTERVAL 5 MINUTE ELSE {now} - INTERVAL 2 HOUR END AS since FROM p)",
        "SELECT event_id, ts, event_type, tier, suspect FROM events, q WHERE ts >= since",
    )


for _label, _time, _saved in (
    ("fresh_checkpoint", "2024-01-20 12:00:00", True),
    ("aged_checkpoint", "2024-02-01 06:00:00", True),
    ("expired_checkpoint", "2024-02-05 00:00:00", True),
    ("safe_window", "2024-01-20 12:00:00", False),
):
    QUERIES[f"replay_from_{_label}"] = (
        _replayed(dt.datetime.fromisoformat(_time), _saved),
        _replay_sql(_time, _saved),
    )
