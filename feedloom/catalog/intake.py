"""Feed, message, routing, sink, conformance and streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import archive as AR
from ..operators import conform as CF
from ..operators import decode as D
from ..operators import envelope as E
from ..operators import routing as RT
from ..operators.ledger import read_committed
from ..operators.mapping import flatten_columns
from ..plans.collections import DEFAULT_COLLECTION, REGISTRY
from ..plans.ingest import CARRIED, route_messages, write_all_tables
from ..session import prepare, table, work_dir
from ..sources.archive import read_archive_files, read_archive_table
from ..sources.changefeed import read_changes, stream_changes
from ..sources.messages import stream_messages
from ..sources.metric_log import metric_lines
from ..streaming import pipelines as ST
from . import feeds
from .samples import AS_OF, as_of
from .telemetry import _DUCK_COUNTERS, LOG, _bucket

QUERIES: dict = {}

# --- change feed --------------------------------------------------------------------------

_CHANGES = (
    f"c AS (SELECT *, {feeds.OPERATION} AS operation, {feeds.COLLECTION} AS collection, "
    f"{feeds.DOCUMENT_OF_OPERATION} AS document, {feeds.KEY_JSON} AS key_json, "
    f"CASE WHEN event_type = 'error' OR {feeds.LOST} THEN NULL ELSE {feeds.DOCUMENT_JSON} END AS whole FROM events), "
    "k AS (SELECT * FROM c WHERE operation <> 'drop')"
)


def _kept(spark, sf_dir):
    return E.keep_operations(feeds.change_events(prepare(spark), sf_dir))


def _envelopes(spark, sf_dir):
    return E.to_envelope(_kept(spark, sf_dir), as_of(), correlation="token")


def _envelope_rows(spark, sf_dir):
    return _envelopes(spark, sf_dir).select(
        "operation", "collection", "database", F.to_json("document").alias("document"),
        "timestamp", "oplog_timestamp", "correlation_id", "resume_token",
    )


_OPLOG = "rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')"
QUERIES["envelopes"] = (
    _envelope_rows,
    f"WITH {_CHANGES} SELECT operation, collection, 'shop' AS database, document, TIMESTAMP '{AS_OF}' AS timestamp, "
    f"{_OPLOG} AS oplog_timestamp, sha256('token-' || event_id) AS correlation_id, 'token-' || event_id AS resume_token FROM k",
)


def _feed_round_trip(spark, sf_dir):
    """The feed written as JSON files and read back through the file source."""
    path = work_dir(prepare(spark), "feed")
    _kept(spark, sf_dir).write.json(path)
    return read_changes(spark, path).select(
        "_id", F.col("ns.coll").alias("collection"), "operationType",
        E.document_id().alias("document_id"), E.document_size().alias("document_size"),
    )


QUERIES["change_feed_files"] = (
    _feed_round_trip,
    f"WITH {_CHANGES} SELECT 'token-' || event_id AS _id, collection, operation AS \"operationType\", 'e' || event_id AS document_id, "
    "CAST(length(coalesce(whole, key_json)) AS BIGINT) AS document_size FROM k",
)


def _feed_stream(spark, sf_dir):
    """The same files as a stream: operations counted through an availableNow run."""
    path, out, mark = (work_dir(prepare(spark), n) for n in ("feed", "envelopes", "checkpoint"))
    feeds.change_events(spark, sf_dir).write.json(path)
    stream = E.keep_operations(stream_changes(spark, path))
    rows = E.to_envelope(stream, as_of(), "token").select("operation", "collection", "resume_token")
    query = (
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(out)


QUERIES["change_feed_stream"] = (
    _feed_stream,
    f"WITH {_CHANGES} SELECT operation, collection, 'token-' || event_id AS resume_token FROM k",
)


def _published(spark, sf_dir):
    path = work_dir(prepare(spark), "topic")
    E.publishable(_envelopes(spark, sf_dir)).withColumn("headers", F.to_json("headers")).write.parquet(path)
    return spark.read.parquet(path)


QUERIES["publish_sink"] = (
    _published,
    f"WITH {_CHANGES} SELECT sha256('token-' || event_id) AS key, "
    "'{\"operation\":\"' || operation || '\",\"collection\":\"' || collection || '\",\"database\":\"shop\",\"document\":' || coalesce(document, 'null') || "
    f"',\"timestamp\":\"{AS_OF.replace(' ', 'T')}.000000Z\",\"oplog_timestamp\":\"' || {_OPLOG} || '\",\"correlation_id\":\"' || sha256('token-' || event_id) || "
    "'\",\"resume_token\":\"token-' || event_id || '\"}' AS value, "
    "'{\"operation\":\"' || operation || '\",\"collection\":\"' || collection || '\",\"database\":\"shop\",\"correlation_id\":\"' || sha256('token-' || event_id) || '\"}' AS headers FROM k",
)


def _dead_letters(spark, sf_dir):
    """Deletes fail to publish: written to the dead-letter sink and read back."""
    path = work_dir(prepare(spark), "dead")
    failed = _envelopes(spark, sf_dir).filter("operation = 'delete'")
    error = F.concat(F.lit("publish timed out for "), "resume_token")
    E.dead_letters(failed, "changes", error, as_of=as_of()).write.json(path)
    back = spark.read.schema("collection string, resume_token string, _error_context struct<original_topic:string,error_message:string,error_timestamp:timestamp,attempts:int>").json(path)
    return back.select("collection", "resume_token", "_error_context.*")


QUERIES["dead_letter_sink"] = (
    _dead_letters,
    f"WITH {_CHANGES} SELECT collection, 'token-' || event_id AS resume_token, 'changes' AS original_topic, "
    f"'publish timed out for token-' || event_id AS error_message, TIMESTAMP '{AS_OF}' AS error_timestamp, 3 AS attempts FROM k WHERE operation = 'delete'",
)

# --- messages -----------------------------------------------------------------------------

_M = (
    f"m AS (SELECT *, {feeds.OPERATION} AS op, {feeds.COLLECTION} AS coll, {feeds.DOCUMENT_OF_OPERATION} AS document, "
    f"{feeds.envelope_sql(feeds.DUCK_STAMP)} AS envelope, {feeds.COPIES} AS copies, "
    f"CASE WHEN {feeds.NO_DATA} OR {feeds.NOT_JSON} THEN 'bad_request' WHEN {feeds.BROKEN} THEN 'format_error' END AS fault, "
    f"CASE WHEN event_id % 2 = 1 AND ({feeds.DOUBLE}) THEN 'outer-' ELSE '' END AS outer_part, md5(CAST(event_id AS VARCHAR)) AS mid FROM events), "
    "d AS (SELECT *, CASE WHEN fault IS NOT NULL THEN fault WHEN coll = 'telemetry' THEN 'skipped_telemetry' "
    "WHEN document IS NULL THEN 'null_document' ELSE 'processed' END AS disposition, "
    "CASE WHEN fault IS NOT NULL THEN outer_part || mid ELSE mid END AS message_id FROM m)"
)


def _routed(spark, sf_dir):
    return route_messages(feeds.messages(prepare(spark), sf_dir))


QUERIES["message_dispositions"] = (
    lambda spark, sf_dir: _routed(spark, sf_dir).groupBy("disposition", "collection").agg(F.count(F.lit(1)).alias("n")),
    f"WITH {_M} SELECT disposition, CASE WHEN fault IS NULL THEN coll END AS collection, CAST(sum(copies) AS BIGINT) AS n FROM d GROUP BY ALL",
)
QUERIES["routed_documents"] = (
    lambda spark, sf_dir: _routed(spark, sf_dir).select(
        "message_id", "pos", "collection", "operation", "correlation_id", "event_ts", "disposition", F.to_json("document").alias("document")
    ),
    f"WITH {_M} SELECT message_id, 0 AS pos, CASE WHEN fault IS NULL THEN coll END AS collection, "
    f"CASE WHEN fault IS NULL OR NOT ({feeds.DOUBLE}) OR true THEN op END AS operation, 'c-' || event_id AS correlation_id, ts AS event_ts, disposition, "
    "CASE WHEN fault IS NULL THEN coalesce(document, 'null') END AS document FROM d, generate_series(1, copies) WHERE true",
)
QUERIES["skipped_documents"] = (
    lambda spark, sf_dir: RT.skipped(_routed(spark, sf_dir)).select("message_id", "collection", "disposition"),
    f"WITH {_M} SELECT message_id, coll AS collection, disposition FROM d, generate_series(1, copies) WHERE disposition LIKE 'skipped%'",
)
QUERIES["rejected_messages"] = (
    lambda spark, sf_dir: RT.rejected(_routed(spark, sf_dir)).select("message_id", "disposition"),
    f"WITH {_M} SELECT message_id, disposition FROM d, generate_series(1, copies) WHERE disposition IN ('bad_request', 'format_error', 'null_document')",
)
QUERIES["error_records"] = (
    lambda spark, sf_dir: D.error_records(D.decode(feeds.messages(prepare(spark), sf_dir)), "archive", as_of()).select(
        "message_id", "error", "error_type", "original_event", "bucket", "path", "error_date", "retryable"
    ),
    f"WITH {_M} SELECT message_id, fault AS error_type, CASE fault WHEN 'bad_request' THEN 'no usable data in message' ELSE 'message data is not base64' END AS error, "
    "'{\"messageId\":\"' || message_id || '\",\"attributes\":{\"operation\":\"' || op || '\",\"collection\":\"' || coll || '\",\"database\":\"shop\",\"correlation_id\":\"c-' || event_id || '\"},'"
    f" || '\"data\":\"' || CASE WHEN {feeds.NO_DATA} THEN '' WHEN {feeds.BROKEN} THEN '%%not base64%%' ELSE base64(encode('plain words')) END || '\",'"
    " || '\"publishTime\":\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || '\"}' AS original_event, 'archive' AS bucket, "
    f"'errors/{AS_OF[:10]}/' || message_id || '_' || CAST(epoch(TIMESTAMP '{AS_OF}') AS BIGINT) || '.json' AS path, "
    f"DATE '{AS_OF[:10]}' AS error_date, false AS retryable FROM d, generate_series(1, copies) WHERE fault IS NOT NULL",
)
QUERIES["delivery_attempt_routes"] = (
    lambda spark, sf_dir: D.route_by_attempts(feeds.messages(prepare(spark), sf_dir)).groupBy("delivery_route").agg(F.count(F.lit(1)).alias("n")),
    f"WITH {_M} SELECT CASE WHEN event_id % 8 + i - 1 >= 5 THEN 'dead_letter' ELSE 'process' END AS delivery_route, count(*) AS n "
    "FROM d, generate_series(1, copies) g(i) GROUP BY 1",
)


def _subscription(spark, sf_dir):
    flat = feeds.messages(prepare(spark), sf_dir).select(
        F.coalesce("message.attributes", "attributes").alias("attributes"), "publishTime"
    )
    return D.with_attribute(flat, "collection", "leads").select(
        F.col("attributes")["operation"].alias("operation"), F.col("attributes")["correlation_id"].alias("correlation_id"), "publishTime"
    )


QUERIES["attribute_subscription"] = (
    _subscription,
    f"WITH {_M} SELECT op AS operation, 'c-' || event_id AS correlation_id, ts AS \"publishTime\" FROM d, generate_series(1, copies) WHERE coll = 'leads'",
)
QUERIES["detailed_log_selection"] = (
    lambda spark, sf_dir: RT.detailed_log_rows(_routed(spark, sf_dir), ["customers", "leads"]).groupBy("collection", "operation").agg(F.count(F.lit(1)).alias("n")),
    f"WITH {_M} SELECT coll AS collection, op AS operation, CAST(sum(copies) AS BIGINT) AS n FROM d WHERE fault IS NULL AND coll IN ('customers', 'leads') GROUP BY ALL",
)


def _bare_messages(spark, sf_dir):
    """Payloads without an envelope: lists, documents naming their collection, bare documents, scalars."""
    doc = feeds.DOCUMENT_JSON
    body = (
        "CASE event_id % 5 WHEN 0 THEN '[' || " + doc + " || ',{\"_id\":\"second\",\"n\":' || event_id || '}]' "
        "WHEN 1 THEN '{\"collection\":\"leads\",\"_id\":\"b' || event_id || '\"}' "
        "WHEN 2 THEN " + doc + " WHEN 3 THEN '{\"_id\":\"b' || event_id || '\"}' ELSE CAST(event_id AS string) END AS body"
    )
    rows = table(prepare(spark), sf_dir, "events").selectExpr("event_id", "ts", body)
    return rows.selectExpr(
        "CAST(NULL AS struct<data:string,attributes:map<string,string>,messageId:string,message_id:string>) AS message",
        "base64(encode(body, 'UTF-8')) AS data",
        "CAST(NULL AS map<string,string>) AS attributes",
        "CAST(event_id AS string) AS messageId",
        "ts AS publishTime",
        "1 AS delivery_attempt",
    )


def _shapes(spark, sf_dir):
    routed = RT.route(RT.dispatch(D.decode(_bare_messages(spark, sf_dir))), REGISTRY, "sysinfo")
    return routed.select("message_id", "pos", "collection", "disposition", "operation", F.to_json("document").alias("document"))


QUERIES["message_shapes"] = (
    _shapes,
    f"WITH b AS (SELECT *, {feeds.DOCUMENT_JSON} AS doc FROM events) "
    "SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(pos AS INTEGER) AS pos, CASE event_id % 5 WHEN 1 THEN 'leads' WHEN 3 THEN 'sysinfo' WHEN 4 THEN 'unknown' ELSE 'customers' END AS collection, "
    "CASE event_id % 5 WHEN 4 THEN 'skipped_unknown' ELSE 'processed' END AS disposition, 'unknown' AS operation, "
    "CASE WHEN pos = 1 THEN '{\"_id\":\"second\",\"n\":' || event_id || '}' WHEN event_id % 5 IN (0, 2) THEN doc "
    "WHEN event_id % 5 = 1 THEN '{\"_id\":\"b' || event_id || '\",\"collection\":\"leads\"}' "
    "WHEN event_id % 5 = 3 THEN '{\"_id\":\"b' || event_id || '\"}' ELSE CAST(event_id AS VARCHAR) END AS document "
    "FROM b, generate_series(0, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) g(pos)",
)

_WATCHED = {"stripe_id": "subscription.stripeCustId", "address_line": "address.line2", "acquisition": "acquisition", "status": "subscription.status"}


def _profile(spark, sf_dir):
    known = _routed(spark, sf_dir).filter(F.col("disposition").isin("processed", "skipped_telemetry"))
    rows = RT.shape_profile(known, _WATCHED)
    return rows.withColumn("keys", F.array_join("keys", ","))


QUERIES["document_shape_profile"] = (
    _profile,
    f"WITH {_M} SELECT message_id, coll AS collection, CASE WHEN event_type = 'error' THEN '_id' WHEN document IS NULL THEN NULL ELSE '_id,email,legacyId,subscription' END AS keys, "
    "CASE WHEN event_type = 'error' THEN 1 WHEN document IS NULL THEN NULL ELSE 4 END AS key_count, 'absent' AS stripe_id, 'absent' AS address_line, 'absent' AS acquisition, "
    "CASE WHEN event_type = 'error' OR document IS NULL THEN 'absent' ELSE 'scalar' END AS status, substring(coalesce(document, 'null'), 1, 500) AS sample "
    "FROM d, generate_series(1, copies) WHERE disposition IN ('processed', 'skipped_telemetry')",
)
QUERIES["collection_schemas"] = (
    lambda spark, sf_dir: RT.collection_shapes(RT.processed(_routed(spark, sf_dir))),
    f"WITH {_M} SELECT coll AS collection, 'OBJECT<_id: STRING, email: STRING, legacyId: BIGINT, subscription: OBJECT<status: STRING>>' AS document_schema, "
    "CAST(sum(copies) AS BIGINT) AS documents FROM d WHERE disposition = 'processed' GROUP BY 1",
)

# --- archive ------------------------------------------------------------------------------

_ARCHIVE_COLUMNS = [
    "message_id", "collection", "ingest_date", "operation", "document_id", "correlation_id", "has_resume_token",
    "parse_warning", "data_size_bytes", "prefix", "path",
]
_ARCHIVE_SQL = (
    f"WITH {_M}, a AS (SELECT *, {feeds.NOT_JSON} AS odd, strftime(ts, '%Y-%m-%dT%H-%M-%S') AS stamp FROM d WHERE NOT ({feeds.NO_DATA}) AND NOT ({feeds.BROKEN})) "
    "SELECT message_id, CASE WHEN odd THEN 'unknown' ELSE coll END AS collection, CAST(ts AS DATE) AS ingest_date, "
    "CASE WHEN odd THEN 'unknown' ELSE op END AS operation, CASE WHEN odd OR document IS NULL THEN 'unknown' ELSE 'e' || event_id END AS document_id, "
    "'c-' || event_id AS correlation_id, false AS has_resume_token, CASE WHEN odd THEN 'payload is not JSON' END AS parse_warning, "
    "CAST(CASE WHEN odd THEN 11 ELSE strlen(envelope) END AS BIGINT) AS data_size_bytes, substring(message_id, 1, 8) AS prefix, "
    "'raw/' || CASE WHEN odd THEN 'unknown' ELSE coll END || '/' || substring(message_id, 1, 8) || '-' || strftime(ts, '%Y-%m-%d') || '/' || "
    f"CASE WHEN odd THEN 'unknown' ELSE op END || '_' || CASE WHEN odd THEN '{AS_OF.replace('-', '').replace(':', '').replace(' ', '_')}' ELSE stamp END || '_' || message_id || '.json' AS path, "
    f"CAST(NULL AS VARCHAR) AS oplog_timestamp, ts AS publish_time, TIMESTAMP '{AS_OF}' AS received_at, sha256(CASE WHEN odd THEN 'plain words' ELSE envelope END) AS payload_sha256 FROM a"
)


def _archived(spark, sf_dir):
    """Messages archived, then the same messages delivered and archived once more on the next day."""
    path = work_dir(prepare(spark), "raw")
    for now in (as_of(), as_of() + F.expr("INTERVAL 1 DAY")):
        AR.write_archive(AR.archive_rows(D.decode(feeds.messages(spark, sf_dir)), now), path)
    return _archive(spark, path)


def _archive(spark, path):
    return read_committed(spark, path).select(*_ARCHIVE_COLUMNS, "oplog_timestamp", "publish_time", "received_at", F.sha2("payload", 256).alias("payload_sha256"))


QUERIES["raw_archive_twice"] = (_archived, _ARCHIVE_SQL)


def _replayed_archive(spark, sf_dir):
    """The archive as a batch source: one plan for live messages and for replays."""
    path = work_dir(prepare(spark), "raw")
    AR.write_archive(AR.archive_rows(D.decode(feeds.messages(spark, sf_dir)), as_of()), path)
    routed = RT.route(RT.dispatch(read_archive_table(spark, path, "customers")), REGISTRY, DEFAULT_COLLECTION)
    return routed.groupBy("collection", "operation", "disposition").agg(F.count(F.lit(1)).alias("n"))


QUERIES["archive_replay"] = (
    _replayed_archive,
    f"WITH {_M} SELECT coll AS collection, op AS operation, disposition, count(*) AS n FROM d WHERE fault IS NULL AND coll = 'customers' GROUP BY ALL",
)

def _replayed_files(spark, sf_dir):
    """Every archived message written as an object of its own, and all objects replayed by a wildcard."""
    path, root = work_dir(prepare(spark), "raw"), work_dir(spark, "objects")
    AR.write_archive(AR.archive_rows(D.decode(feeds.messages(spark, sf_dir)), as_of()), path)
    AR.write_objects(read_committed(spark, path), root)
    files = read_archive_files(spark, f"{root}/raw/*/*/*")
    routed = RT.route(RT.dispatch(files), REGISTRY, DEFAULT_COLLECTION).select("message_id", "collection", "operation", "disposition")
    return routed.join(files.select("message_id", F.sha2("payload", 256).alias("payload_sha256")), "message_id")


QUERIES["archive_files_replay"] = (
    _replayed_files,
    f"WITH {_M}, r AS (SELECT *, {feeds.NOT_JSON} AS odd FROM d WHERE NOT ({feeds.NO_DATA}) AND NOT ({feeds.BROKEN})) "
    "SELECT message_id, CASE WHEN NOT odd THEN coll END AS collection, CASE WHEN odd THEN 'unknown' ELSE op END AS operation, disposition, "
    "sha256(CASE WHEN odd THEN 'plain words' ELSE envelope END) AS payload_sha256 FROM r",
)

# --- conformance --------------------------------------------------------------------------

# customer rows against a target that lacks a column, has another, and disagrees on types.
TARGET = T.StructType(
    [
        T.StructField("c_custkey", T.StringType()),
        T.StructField("c_name", T.LongType()),
        T.StructField("c_acctbal", T.LongType()),
        T.StructField("c_mktsegment", T.BooleanType()),
        T.StructField("c_phone", T.StringType()),
        T.StructField("c_since", T.TimestampType()),
        T.StructField("c_rank", T.DoubleType()),
    ]
)


def _drifted(spark, sf_dir):
    return table(prepare(spark), sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey",
        "if(c_custkey % 4 = 0, '2024-01-01 00:00:00', if(c_custkey % 4 = 1, 'soon', NULL)) AS c_since",
        "if(c_custkey % 3 = 0, CAST(c_nationkey AS string), NULL) AS c_rank",
    )


QUERIES["conform_to_schema"] = (
    lambda spark, sf_dir: CF.conform(_drifted(spark, sf_dir), TARGET),
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS BIGINT) AS c_name, CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal, true AS c_mktsegment, "
    "CAST(NULL AS VARCHAR) AS c_phone, CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS c_since, "
    "CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS DOUBLE) END AS c_rank FROM customer",
)
_SHARE = "printf('%.1f', {0} * 100.0 / n)"
_DRIFT = (
    "t AS (SELECT count(*) AS n, count(*) FILTER (c_custkey % 4 <> 0) AS since_null, count(*) FILTER (c_custkey % 4 = 1) AS since_lost, "
    "count(*) FILTER (c_custkey % 3 <> 0) AS rank_null FROM customer), "
    "w AS (SELECT 0 AS position, 'SCHEMA_DRIFT: Added missing field ''c_phone'' (string) with None' AS message "
    "UNION ALL SELECT 1, 'SCHEMA_DRIFT: Dropping unexpected fields: {''c_nationkey''}' "
    "UNION ALL SELECT 3, 'DATA_QUALITY: Field ''c_name'' has 100.0% null values' "
    "UNION ALL SELECT 3, 'TYPE_MISMATCH: COLUMN_CAST_FAILED for ''c_name'' in ' || n || ' rows' FROM t "
    "UNION ALL SELECT 6, 'DATA_QUALITY: Field ''c_phone'' has 100.0% null values' "
    "UNION ALL SELECT 7, 'DATA_QUALITY: Field ''c_since'' has ' || " + _SHARE.format("since_null") + " || '% null values' FROM t "
    "UNION ALL SELECT 7, 'TYPE_MISMATCH: COLUMN_CAST_FAILED for ''c_since'' in ' || since_lost || ' rows' FROM t "
    "UNION ALL SELECT 8, 'DATA_QUALITY: Field ''c_rank'' has ' || " + _SHARE.format("rank_null") + " || '% null values' FROM t)"
)
QUERIES["drift_report"] = (
    lambda spark, sf_dir: CF.drift_report(_drifted(spark, sf_dir), TARGET, "customers", as_of()),
    f"WITH {_DRIFT} SELECT position, message, 'customers' AS collection, CASE WHEN contains(message, 'DATA_QUALITY') THEN 'INFO' ELSE 'WARNING' END AS severity, "
    f"TIMESTAMP '{AS_OF}' AS timestamp FROM w",
)
QUERIES["drift_summary"] = (
    lambda spark, sf_dir: CF.drift_summary(CF.drift_report(_drifted(spark, sf_dir), TARGET, "customers", as_of())),
    f"WITH {_DRIFT} SELECT 'customers' AS collection, count(*) AS schema_drift_count, "
    "(SELECT string_agg(message, '; ') FROM (SELECT message FROM w ORDER BY position, message LIMIT 3)) AS schema_drift_summary FROM w",
)
QUERIES["recovered_table"] = (
    lambda spark, sf_dir: CF.recover(_drifted(spark, sf_dir), TARGET)[0],
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS BIGINT) AS c_name, CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal, true AS c_mktsegment, "
    "CAST(NULL AS VARCHAR) AS c_phone, CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS c_since, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS DOUBLE) END AS c_rank FROM customer",
)
QUERIES["recovery_summary"] = (
    lambda spark, sf_dir: CF.recover(_drifted(spark, sf_dir), TARGET)[1],
    "SELECT true AS recovery_mode, 'c_name,c_since' AS dropped_columns, 7 AS original_column_count, 'PARTIAL SUCCESS: Saved 5/7 columns' AS message "
    "FROM customer HAVING count(*) > 0",
)


def _mapped_quality(spark, sf_dir):
    """Null and lost values of every field of the customers table as written from redelivered messages, by operation."""
    out = work_dir(prepare(spark), "tables")
    written = write_all_tables(feeds.messages(spark, sf_dir), out, work_dir(spark, "routed"), as_of(), ["customers"])
    return CF.column_measures(read_committed(spark, written["customers"]), REGISTRY["customers"].schema, ("_operation",), "_lost")


_ALWAYS = ("pk_client", "pk_yearmonth", "des_data_origin", "des_source", "val_active_orders_count")
_OF_DOCUMENTS = ("des_email", "val_legacy_id", "des_subscription_status")
QUERIES["mapped_null_counts"] = (
    _mapped_quality,
    f"WITH {_M}, c AS (SELECT op, count(*) AS rows FROM d WHERE disposition = 'processed' AND coll = 'customers' GROUP BY 1), "
    "f AS (SELECT unnest([" + ", ".join(f"'{name}'" for name, _ in REGISTRY["customers"].target_columns) + "]) AS field) "
    f"SELECT op AS _operation, rows, field, CASE WHEN field IN {_ALWAYS} OR (field IN {_OF_DOCUMENTS} AND op NOT IN ('delete', 'drop')) THEN 0 ELSE rows END AS nulls, "
    "CAST(0 AS BIGINT) AS lost FROM c, f",
)
QUERIES["flattened_messages"] = (
    lambda spark, sf_dir: flatten_columns(
        feeds.change_events(prepare(spark), sf_dir).selectExpr("_id", "ns", "named_struct('at', clusterTime, 'op', named_struct('name', operationType)) AS meta"), "_"
    ),
    f"SELECT 'token-' || event_id AS _id, 'shop' AS ns_db, {feeds.COLLECTION} AS ns_coll, ts AS meta_at, {feeds.OPERATION} AS meta_op_name FROM events",
)
QUERIES["metric_lines_in_range"] = (
    lambda spark, sf_dir: metric_lines(
        feeds.metric_log(prepare(spark), sf_dir),
        __import__("datetime").datetime(2024, 1, 10), __import__("datetime").datetime(2024, 1, 20),
    ).select("seq", "ts", "service", "severity", "text"),
    f"WITH {LOG} SELECT seq, ts, service, severity, text FROM log WHERE contains(text, 'METRIC:') AND ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'",
)

# --- all collections in one run -----------------------------------------------------------


def _all_tables(spark, sf_dir):
    """Every supported collection's table, written twice from messages with redelivered copies, counted per table."""
    out = work_dir(prepare(spark), "tables")
    for _ in range(2):
        written = write_all_tables(feeds.messages(spark, sf_dir), out, work_dir(spark, "routed"), as_of())
    rows = None
    for name, path in written.items():
        one = read_committed(spark, path).select(F.lit(name).alias("collection"), F.col("_operation").alias("operation"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("collection", "operation").agg(F.count(F.lit(1)).alias("n"))


QUERIES["all_tables_written"] = (
    _all_tables,
    f"WITH {_M} SELECT coll AS collection, op AS operation, count(*) AS n FROM d WHERE disposition = 'processed' GROUP BY ALL",
)



def _row_conservation(spark, sf_dir):
    """Where every routed document of a batch ended: a table, the skipped or the rejected rows."""
    out = work_dir(prepare(spark), "tables")
    written = write_all_tables(feeds.messages(spark, sf_dir), out, work_dir(spark, "routed"), as_of())
    rows = read_committed(spark, f"{out}/_skipped").select("disposition").unionByName(read_committed(spark, f"{out}/_rejected").select("disposition"))
    for path in written.values():
        rows = rows.unionByName(read_committed(spark, path).select(F.lit("processed").alias("disposition")))
    return rows.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))


QUERIES["row_conservation"] = (_row_conservation, f"WITH {_M} SELECT disposition, count(*) AS n FROM d GROUP BY ALL")

# --- streaming ----------------------------------------------------------------------------


def _written_messages(spark, sf_dir) -> str:
    path = work_dir(prepare(spark), "messages")
    feeds.messages(spark, sf_dir).write.parquet(path)
    return path


def _archive_stream(spark, sf_dir):
    source = _written_messages(spark, sf_dir)
    out, mark = work_dir(spark, "raw"), work_dir(spark, "checkpoint")
    stream = stream_messages(spark, source, "parquet")
    ST.archive_consumer(stream, out, mark, as_of()).awaitTermination()
    return _archive(spark, out)


QUERIES["archive_stream"] = (_archive_stream, _ARCHIVE_SQL)


def _transform_stream(spark, sf_dir):
    """Collection tables, skipped and rejected rows of a streamed topic, counted per sink."""
    source = _written_messages(spark, sf_dir)
    out, mark = work_dir(spark, "tables"), work_dir(spark, "checkpoint")
    stream = stream_messages(spark, source, "parquet")
    ST.transform_consumer(stream, out, work_dir(spark, "routed"), mark, as_of()).awaitTermination()
    tables = [
        read_committed(spark, f"{out}/{name}").select(
            F.lit(name).alias("sink"), F.col("_operation").alias("operation")
        )
        for name in ("customers", "leads", "changelogs", "sysusers", "users-metadata")
    ]
    for label in ("skipped", "rejected"):
        tables.append(read_committed(spark, f"{out}/_{label}").select(F.lit(label).alias("sink"), "operation"))
    rows = tables[0]
    for other in tables[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("sink", "operation").agg(F.count(F.lit(1)).alias("n"))


QUERIES["transform_stream"] = (
    _transform_stream,
    f"WITH {_M} SELECT CASE WHEN disposition = 'processed' THEN coll WHEN disposition LIKE 'skipped%' THEN 'skipped' ELSE 'rejected' END AS sink, "
    "op AS operation, count(*) AS n FROM d GROUP BY ALL",
)


def _counter_stream(spark, sf_dir):
    """Counters of a log that streams in without order, in micro-batches, two of them after restarts, and parts joined between."""
    path, out, mark = (work_dir(prepare(spark), n) for n in ("log", "counters", "checkpoint"))
    log = feeds.metric_log(spark, sf_dir).withColumn("_part", F.pmod(F.xxhash64("seq"), F.lit(4)))
    for parts in ("_part < 2", "_part = 2", "_part = 3"):
        log.filter(parts).drop("_part").write.mode("append").parquet(path)
        stream = spark.readStream.schema(log.drop("_part").schema).parquet(path)
        ST.counter_stream(stream, out, mark, 3600).awaitTermination()
        if parts == "_part = 2":
            ST.compact_counters(spark, out)
    return ST.read_counters(spark, out)


QUERIES["counter_stream"] = (
    _counter_stream,
    f"WITH {LOG} SELECT {_bucket('ts', 3600)} AS period_start, " + ", ".join(f"count(*) FILTER ({p}) AS {n}" for n, p in _DUCK_COUNTERS.items())
    + " FROM log GROUP BY 1",
)
