"""Change feed, messages, metric log and checkpoints derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread, table

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# Portable SQL over ``events`` columns, shared by the Spark builders and the oracles.
OPERATION = (
    "CASE WHEN event_type IN ('signup', 'purchase') THEN 'insert' WHEN event_type = 'click' THEN 'update' "
    "WHEN event_type = 'view' THEN 'replace' WHEN event_id % 7 = 0 THEN 'drop' ELSE 'delete' END"
)
COLLECTION = (
    "CASE user_id % 6 WHEN 0 THEN 'customers' WHEN 1 THEN 'leads' WHEN 2 THEN 'changelogs' "
    "WHEN 3 THEN 'sysusers' WHEN 4 THEN 'users-metadata' ELSE 'telemetry' END"
)
# A write whose document is gone by the time it is looked up.
LOST = "(event_type = 'click' AND event_id % 25 = 4)"
KEY_JSON = "'{\"_id\":\"e' || CAST(event_id AS STRING) || '\"}'"
DOCUMENT_JSON = (
    "'{\"_id\":\"e' || CAST(event_id AS STRING) || '\",\"email\":\"u' || CAST(user_id AS STRING) || '@example.org\",' || "
    "'\"legacyId\":' || CAST(event_id AS STRING) || ',\"subscription\":{\"status\":\"' || event_type || '\"}}'"
)
DOCUMENT_OF_OPERATION = (
    f"CASE WHEN event_type = 'error' THEN {KEY_JSON} WHEN {LOST} THEN NULL ELSE {DOCUMENT_JSON} END"
)


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change event per row of ``events``, in the change-feed schema."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('token-', event_id) AS _id",
        f"{OPERATION} AS operationType",
        "ts AS clusterTime",
        f"named_struct('db', 'shop', 'coll', {COLLECTION}) AS ns",
        f"parse_json({KEY_JSON}) AS documentKey",
        f"parse_json(if(event_type = 'error' OR {LOST}, NULL, {DOCUMENT_JSON})) AS fullDocument",
    )


SPARK_STAMP = f"date_format(ts, \"{MICROS}\")"
DUCK_STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"


def envelope_sql(stamp: str) -> str:
    """The envelope's JSON text; ``stamp`` is the engine's own way to print the event time."""
    members = [
        ("operation", f"'\"' || {OPERATION} || '\"'"),
        ("collection", f"'\"' || {COLLECTION} || '\"'"),
        ("database", "'\"shop\"'"),
        ("document", f"coalesce({DOCUMENT_OF_OPERATION}, 'null')"),
        ("timestamp", f"'\"' || {stamp} || '\"'"),
        ("correlation_id", "'\"c-' || CAST(event_id AS STRING) || '\"'"),
    ]
    body = " || ',' || ".join(f"'\"{name}\":' || {text}" for name, text in members)
    return "'{' || " + body + " || '}'"


# Which events become which kind of message.
NO_DATA = "event_id % 50 = 8"
BROKEN = "event_id % 50 = 7"
NOT_JSON = "event_id % 50 = 9"
DOUBLE = "event_id % 10 = 1"
COPIES = "CASE WHEN event_id % 20 = 3 THEN 3 ELSE 1 END"


def messages(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """Topic messages of the change events: single and double wrapped, damaged, empty, repeated."""
    events = table(spark, sf_dir, "events")
    base = spread(events, events).selectExpr(
        "event_id",
        "ts",
        f"{COLLECTION} AS coll",
        f"{OPERATION} AS op",
        f"{envelope_sql(SPARK_STAMP)} AS envelope",
        "md5(CAST(event_id AS string)) AS mid",
    )
    encoded = base.selectExpr(
        "*",
        f"CASE WHEN {NO_DATA} THEN '' WHEN {BROKEN} THEN '%%not base64%%' "
        f"WHEN {NOT_JSON} THEN base64(encode('plain words', 'UTF-8')) "
        f"WHEN {DOUBLE} THEN base64(encode(concat('{{\"message\":{{\"data\":\"', "
        "replace(base64(encode(envelope, 'UTF-8')), '\\r\\n', ''), '\",\"messageId\":\"', mid, '\"}}'), 'UTF-8')) "
        "ELSE base64(encode(envelope, 'UTF-8')) END AS body",
    )
    if copies:
        encoded = encoded.selectExpr("*", f"explode(sequence(1, {COPIES})) AS delivery")
    else:
        encoded = encoded.selectExpr("*", "1 AS delivery")
    attributes = "map('operation', op, 'collection', coll, 'database', 'shop', 'correlation_id', concat('c-', event_id))"
    return encoded.selectExpr(
        # Even events use the wrapped form, odd ones carry the members directly.
        f"if(event_id % 2 = 0, named_struct('data', body, 'attributes', {attributes}, "
        "'messageId', mid, 'message_id', CAST(NULL AS string)), NULL) AS message",
        "if(event_id % 2 = 0, NULL, body) AS data",
        f"if(event_id % 2 = 0, NULL, {attributes}) AS attributes",
        f"if(event_id % 2 = 0, NULL, if({DOUBLE}, concat('outer-', mid), mid)) AS messageId",
        "ts AS publishTime",
        "CAST(event_id % 8 AS int) + delivery - 1 AS delivery_attempt",
    )


# --- metric log ---------------------------------------------------------------------------

METRIC_NAME = (
    "CASE event_type WHEN 'signup' THEN 'change_stream_event' WHEN 'purchase' THEN 'pubsub_published' "
    "WHEN 'click' THEN 'gcs_write_success' WHEN 'view' THEN CASE event_id % 5 WHEN 0 THEN 'system_stats' "
    "WHEN 1 THEN 'function_stats' ELSE 'message_received' END "
    "ELSE CASE event_id % 4 WHEN 0 THEN 'publish_failed' WHEN 1 THEN 'format_error' "
    "WHEN 2 THEN 'unexpected_error' ELSE 'gcs_write_failed' END END"
)
SERVICE = (
    "CASE WHEN event_type IN ('signup', 'purchase') OR (event_type = 'error' AND event_id % 4 = 0) "
    "OR (event_type = 'view' AND event_id % 5 = 0) THEN 'ingestor' ELSE 'writer' END"
)
WRITES = "event_type IN ('signup', 'purchase', 'click')"


def _line(number: int, name: str, where: str, severity: str, service: str, text: str) -> str:
    return (
        f"SELECT event_id * 4 + {number} AS seq, ts, {service} AS service, {severity} AS severity, {text} AS text, "
        f"{name} AS name, {COLLECTION} AS collection, {OPERATION} AS operation, "
        "CASE WHEN event_type = 'error' THEN 'type-' || CAST(event_id % 3 AS STRING) END AS error_type, "
        "value * 20 AS latency_ms, value * 8 AS write_ms, event_id % 5000 AS size_bytes, event_id % 10000 AS queue_depth "
        f"FROM {{events}} WHERE {where}"
    )


# Up to three lines per event: its own, a slow-publish line, a dead-letter or data-loss line.
LOG_SQL = " UNION ALL ".join(
    [
        _line(
            0, METRIC_NAME, "true", "CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END", SERVICE,
            f"'METRIC:' || {METRIC_NAME} || ' ' || {COLLECTION} || "
            f"CASE WHEN {WRITES} THEN ' latency ' || CAST(CAST(floor(value * 20) AS BIGINT) AS STRING) || '.5ms' ELSE '' END",
        ),
        _line(
            1, "'slow_publish'", "event_type = 'purchase' AND value > 50", "'WARNING'", "'ingestor'",
            "'METRIC:slow_publish'",
        ),
        _line(
            2, "'dead_letter'", "event_type = 'error' AND event_id % 4 = 0", "'WARNING'", "'ingestor'",
            "'METRIC:dead_letter'",
        ),
        _line(
            3, "''", "event_type = 'error' AND event_id % 16 = 0", "'CRITICAL'", "'ingestor'",
            "CASE WHEN event_id % 32 = 0 THEN 'DATA LOSS - Message dropped' ELSE 'Failed to send to DLQ' END",
        ),
    ]
)


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric log in its source schema; every line comes from one scan of ``events``."""
    events = table(spark, sf_dir, "events")
    name = METRIC_NAME
    lines = (
        "filter(array("
        f"named_struct('n', 0, 'keep', true, 'severity', if(event_type = 'error', 'ERROR', 'INFO'), 'service', {SERVICE}, "
        f"'text', concat('METRIC:', {name}, ' ', {COLLECTION}, if({WRITES}, concat(' latency ', CAST(floor(value * 20) AS bigint), '.5ms'), ''))), "
        "named_struct('n', 1, 'keep', event_type = 'purchase' AND value > 50, 'severity', 'WARNING', 'service', 'ingestor', 'text', 'METRIC:slow_publish'), "
        "named_struct('n', 2, 'keep', event_type = 'error' AND event_id % 4 = 0, 'severity', 'WARNING', 'service', 'ingestor', 'text', 'METRIC:dead_letter'), "
        "named_struct('n', 3, 'keep', event_type = 'error' AND event_id % 16 = 0, 'severity', 'CRITICAL', 'service', 'ingestor', "
        "'text', if(event_id % 32 = 0, 'DATA LOSS - Message dropped', 'Failed to send to DLQ'))"
        "), l -> l.keep)"
    )
    return events.selectExpr(
        "event_id", "ts", f"explode({lines}) AS line", f"{COLLECTION} AS coll", f"{OPERATION} AS op", "event_type", "value"
    ).selectExpr(
        "event_id * 4 + line.n AS seq",
        "ts",
        "line.service AS service",
        "line.severity AS severity",
        "line.text AS text",
        "if(event_type = 'error', map('collection', coll, 'operation', op, 'error_type', concat('type-', event_id % 3)), "
        "map('collection', coll, 'operation', op)) AS labels",
        "named_struct('latency_ms', value * 20, 'write_ms', value * 8, 'size_bytes', event_id % 5000, "
        "'queue_depth', event_id % 10000) AS payload",
    )


CHECKPOINT_SQL = (
    "SELECT event_id - event_id % 100 AS checkpoint_id, max(ts) AS ts, "
    "'token-' || CAST(max(event_id) AS STRING) AS token, CAST(sum(event_id % 13) AS BIGINT) AS save_ms, "
    "max(event_id) % 7 < 5 AND max(event_id) % 23 > 2 AS ok FROM {events} GROUP BY event_id - event_id % 100"
)


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpoint per hundred events: time, token, save duration and outcome."""
    return spark.sql(CHECKPOINT_SQL, events=table(spark, sf_dir, "events"))


def lag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster time and ingest time of every event; ingest trails by ``value`` seconds."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS seq",
        "ts AS cluster_time",
        "ts + INTERVAL '1' MILLISECOND * CAST(round(value * 100) * 10 AS int) AS ingested_at",
    )


def bare(sql: str) -> str:
    return sql.replace("{events}", "events")


def constant_time(text: str):
    return F.lit(text).cast("timestamp")
