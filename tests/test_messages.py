"""Decoding, routing, conservation, archive sources and the streaming sinks."""

import datetime as dt
import json

import pytest
from helpers import encoded, envelope, messages
from pyspark.sql import functions as F

from feedloom.catalog import feeds
from feedloom.catalog.samples import as_of
from feedloom.operators import archive as AR
from feedloom.operators import conform as CF
from feedloom.operators import ledger
from feedloom.operators.decode import decode, error_records, is_retryable
from feedloom.operators.envelope import to_envelope
from feedloom.operators.ledger import read_committed
from feedloom.operators.routing import processed, rejected, skipped
from feedloom.plans.collections import REGISTRY
from feedloom.plans.counters import counters_per_period
from feedloom.plans.ingest import read_drift, route_messages
from feedloom.session import work_dir
from feedloom.sources.archive import read_archive_files
from feedloom.sources.messages import MESSAGE_SCHEMA, from_kafka, read_messages, stream_messages
from feedloom.sources.metric_log import read_metric_log
from feedloom.streaming import pipelines as ST


def test_no_message_is_lost(spark, sf_dir):
    raw = feeds.messages(spark, sf_dir)
    routed = route_messages(raw)
    parts = [f(routed).count() for f in (processed, skipped, rejected)]
    assert sum(parts) == raw.count() and min(parts) > 0


def test_list_message_is_routed_by_its_first_element(spark):
    body = [{"_id": "1", "email": "a", "createdAt": "2024-01-01"}, {"_id": "2", "collection": "orders"}]
    rows = route_messages(messages(spark, [body])).orderBy("pos").collect()
    assert [(r["pos"], r["collection"], r["disposition"]) for r in rows] == [
        (0, "customers", "processed"), (1, "customers", "processed"),
    ]


def test_null_document_unknown_and_scalar(spark):
    payloads = [envelope("orders", None), envelope("nowhere", {"_id": 1}), {"_id": 1}, "5", "[]", {"collection": "leads", "_id": 2}]
    rows = {r["message_id"]: r for r in route_messages(messages(spark, payloads)).collect()}
    assert [rows[f"m{i}"]["disposition"] for i in range(6)] == [
        "null_document", "skipped_nowhere", "processed", "skipped_unknown", rows["m4"]["disposition"], "processed",
    ]
    assert rows["m2"]["collection"] == "customers" and rows["m5"]["collection"] == "leads"


def test_damaged_messages(spark):
    inner = {"message": {"data": encoded(envelope("orders", {"_id": "o"})), "messageId": "inner"}}
    rows = [
        {"message": {"data": "%%%", "messageId": "a"}},
        {"message": {"messageId": "b"}},
        {"message": {"data": encoded("not json"), "messageId": "c"}},
        {"data": encoded(inner), "messageId": "outer"},
        {"message": {"data": encoded("x" * 3)[:-1] + "!", "message_id": "e"}},
    ]
    got = {r["message_id"]: r["decode_error"] for r in decode(spark.createDataFrame(rows, MESSAGE_SCHEMA)).collect()}
    assert got == {"a": "format_error", "b": "bad_request", "c": "bad_request", "inner": None, "e": "format_error"}
    flags = spark.createDataFrame([("format_error",), ("unexpected_error",)], "e string").select(is_retryable(F.col("e")))
    assert [r[0] for r in flags.collect()] == [False, True]


def test_kafka_and_json_sources(spark, tmp_path):
    message = {"data": encoded(envelope("orders", {"_id": "o"})), "messageId": "k", "attributes": {"collection": "orders"}}
    records = spark.createDataFrame([(json.dumps(message).encode(), None)], "value binary, timestamp timestamp")
    assert route_messages(from_kafka(records)).first()["collection"] == "orders"
    (tmp_path / "m.json").write_text(json.dumps(message))
    assert route_messages(read_messages(spark, str(tmp_path))).first()["message_id"] == "k"


def test_archived_files_replay_by_wildcard(spark, tmp_path):
    folder = tmp_path / "raw" / "orders" / "abc-2024-01-01"
    folder.mkdir(parents=True)
    (folder / "insert_x_m1.json").write_text(json.dumps(envelope("orders", {"_id": "o1"}), indent=1))
    (folder / "insert_x_m2.json").write_text("broken")
    from feedloom.plans.collections import DEFAULT_COLLECTION
    from feedloom.operators.routing import dispatch, route

    rows = route(dispatch(read_archive_files(spark, f"{tmp_path}/raw/orders/*/*")), REGISTRY, DEFAULT_COLLECTION).collect()
    assert {(r["message_id"], r["disposition"]) for r in rows} == {("m1", "processed"), ("m2", "bad_request")}


def test_archive_files_are_read_as_bytes(spark, tmp_path):
    folder = tmp_path / "raw" / "orders" / "m1-2024-01-01"
    folder.mkdir(parents=True)
    bodies = {"m1": json.dumps(envelope("orders", {"_id": "é"})).encode(), "m2": b'{"a":"\xff"}', "m_3": b" ", "m4": b'{"collection":"orders","document":{"_id":"1"}}\r\n'}
    for name, body in bodies.items():
        (folder / f"insert_20240101_000000_{name}.json").write_bytes(body)
    (folder / "notes.txt").write_text("no object")
    (folder / "insert_20240101_000000_m5.json").write_bytes(b"")
    rows = {r["message_id"]: r for r in read_archive_files(spark, f"{tmp_path}/raw/*/*").collect()}
    assert {name: bytes(r["payload"]) for name, r in rows.items()} == bodies
    assert {name for name, r in rows.items() if r["decode_error"] == "bad_request"} == {"m2", "m_3"}
    assert read_archive_files(spark, f"{tmp_path}/raw/*/*", modified_after="2999-01-01 00:00:00").count() == 0
    assert read_archive_files(spark, f"{tmp_path}/raw/*/*", modified_before="2999-01-01 00:00:00").count() == 4


def test_objects_are_written_once_and_whole(spark, tmp_path):
    rows = AR.archive_rows(decode(messages(spark, [envelope("orders", {"_id": "1"}), "plain words"])), as_of())
    for _ in range(2):
        assert AR.write_objects(rows, str(tmp_path)) == 2
    files = [p for p in tmp_path.rglob("*") if p.is_file()]
    assert {str(p.relative_to(tmp_path)): p.read_bytes() for p in files} == {r["path"]: bytes(r["payload"]) for r in rows.collect()}


def test_archive_adds_only_unseen_messages(spark):
    path = work_dir(spark, "raw")
    first = messages(spark, [envelope("orders", {"_id": "1"}), envelope("orders", {"_id": "2"})])
    both = first.unionByName(
        spark.createDataFrame([{"message": {"data": encoded(envelope("orders", {"_id": "3"})), "messageId": "m9"}}], MESSAGE_SCHEMA)
    )
    AR.write_archive(AR.archive_rows(decode(first), as_of()), path)
    AR.write_archive(AR.archive_rows(decode(both), as_of()), path)
    assert sorted(r["message_id"] for r in spark.read.parquet(path).collect()) == ["m0", "m1", "m9"]


def test_correlation_ids(spark, sf_dir):
    changes = feeds.change_events(spark, sf_dir)
    again = [to_envelope(changes, as_of(), "token").select(F.min("correlation_id")).first()[0] for _ in range(2)]
    assert again[0] == again[1]
    assert to_envelope(changes).select(F.count_distinct("correlation_id")).first()[0] == changes.count()


def test_archive_stream_survives_a_restart(spark, sf_dir):
    source, out, mark = (work_dir(spark, n) for n in ("in", "raw", "mark"))
    feeds.messages(spark, sf_dir).write.parquet(source)
    for _ in range(2):
        ST.archive_consumer(stream_messages(spark, source, "parquet"), out, mark, as_of()).awaitTermination()
    expected = AR.archive_rows(decode(feeds.messages(spark, sf_dir)), as_of()).select("path").distinct().count()
    stored = read_committed(spark, out)
    assert stored.count() == expected == stored.select("path").distinct().count()


def test_counters_take_late_rows_and_count_a_retried_batch_once(spark, sf_dir, monkeypatch):
    path, out, mark = (work_dir(spark, n) for n in ("log", "counters", "mark"))
    log = feeds.metric_log(spark, sf_dir)
    names = ["pubsub_published", "function_messages_received"]
    middle = log.select(F.percentile_approx("ts", 0.5)).first()[0]

    def run():
        stream = spark.readStream.schema(log.schema).parquet(path)
        ST.counter_stream(stream, out, mark, 3600, names).awaitTermination()

    def told():
        return {r["period_start"]: tuple(r[n] for n in names) for r in ST.read_counters(spark, out).collect()}

    log.filter(F.col("ts") >= middle).write.parquet(path)
    run()
    log.filter(F.col("ts") < middle).write.mode("append").parquet(path)  # all of it older than what was counted

    def dies(*_):
        raise RuntimeError("lost")

    before = told()
    with monkeypatch.context() as broken:
        broken.setattr(ledger, "_commit", dies)
        with pytest.raises(Exception, match="lost"):
            run()
    assert told() == before
    run()
    want = {r["period_start"]: tuple(r[n] for n in names) for r in counters_per_period(log, 3600, names).collect()}
    assert told() == want and set(before) < set(want)
    ST.compact_counters(spark, out)
    assert told() == want


def test_metric_log_files(spark, sf_dir):
    path = work_dir(spark, "log")
    log = feeds.metric_log(spark, sf_dir)
    log.write.json(path)
    assert read_metric_log(spark, path).count() == log.count()


def test_empty_table_gives_one_warning(spark):
    empty = spark.createDataFrame([], REGISTRY["coupons"].schema)
    assert [r["message"] for r in CF.drift_report(empty, REGISTRY["coupons"].schema, "coupons").collect()] == ["DataFrame is empty"]


@pytest.mark.parametrize(
    "text,severity",
    [("CRITICAL: x", "ERROR"), ("DATA_QUALITY: x", "INFO"), ("TYPE_MISMATCH: x", "WARNING"), ("SCHEMA_DRIFT: x", "WARNING")],
)
def test_severity(spark, text, severity):
    assert spark.range(1).select(CF.severity_of(F.lit(text))).first()[0] == severity


def test_processed_table_partitions(spark, sf_dir):
    from feedloom.catalog.documents import SAMPLES
    from feedloom.plans.ingest import collection_table

    out = work_dir(spark, "processed")
    for _ in range(2):
        AR.write_collection_table(collection_table(SAMPLES["coupons"].messages(spark, sf_dir), "coupons", as_of()), out)
    back = read_committed(spark, out)
    assert back.count() == SAMPLES["coupons"].documents(spark, sf_dir).count()
    assert {"_operation", "ingest_date"} <= set(back.columns)


def test_second_batch_of_a_day_adds_to_the_table(spark, sf_dir, tmp_path):
    from feedloom.catalog.documents import SAMPLES
    from feedloom.plans.ingest import collection_table

    out, first = str(tmp_path / "t"), SAMPLES["coupons"].messages(spark, sf_dir)
    table = collection_table(first, "coupons", as_of())
    half = table.filter("crc32(_message_id) % 2 = 0")
    for part in (half, table, table):
        AR.write_collection_table(part, out, as_of())
    assert read_committed(spark, out).count() == table.count() > half.count() > 0


def test_replay_of_a_payload_that_is_not_utf8(spark, tmp_path):
    from feedloom.sources.archive import FILE_NAME, read_archive_table

    rows = spark.createDataFrame([("m_1", "c", "insert", None, bytearray(b"\xff{"))], "message_id string, correlation_id string, operation string, publish_time timestamp, payload binary")
    rows.write.parquet(str(tmp_path / "raw"))
    assert [r["decode_error"] for r in read_archive_table(spark, str(tmp_path / "raw")).collect()] == ["bad_request"]
    import re

    assert re.search(FILE_NAME, "raw/c/p/insert_20240101_000000_proj_77.json")[1] == "proj_77"
    assert re.search(FILE_NAME, "raw/c/p/update_2024-01-01T00-00-00_proj_77.json")[1] == "proj_77"


def test_transform_stream_takes_late_rows_and_drops_late_copies(spark):
    source, out, mark = (work_dir(spark, n) for n in ("in", "tables", "mark"))

    def deliver(*numbers_and_days):
        rows = [
            {"message": {"data": encoded(envelope("coupons", {"_id": f"d{n}"})), "messageId": f"m{n}"}, "publishTime": dt.datetime(2024, 1, day)}
            for n, day in numbers_and_days
        ]
        rows += [{"message": {"data": "%%%", "messageId": ""}}, {"message": {"data": "%%", "messageId": ""}}]
        spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        ST.transform_consumer(stream_messages(spark, source, "parquet"), out, work_dir(spark, "routed"), mark, as_of()).awaitTermination()

    deliver((1, 20), (2, 20), (2, 20))
    deliver((1, 20), (3, 2))
    assert sorted(r[0] for r in read_committed(spark, f"{out}/coupons").select("_message_id").collect()) == ["m1", "m2", "m3"]
    assert read_committed(spark, f"{out}/_rejected").count() == 2
    drift = read_drift(spark, out, ["coupons"])
    assert drift.filter("timestamp IS NULL OR collection <> 'coupons'").count() == 0
    told = drift.filter("document_id IS NULL").groupBy("position", "message").count()
    assert told.agg(F.max("count")).first()[0] == 2  # once for each micro-batch that brought rows


def test_an_error_record_holds_the_message_as_delivered(spark):
    record = error_records(decode(messages(spark, ["no json"])), "archive", as_of()).first()
    event = json.loads(record["original_event"])
    assert event["messageId"] == "m0" and event["data"] == encoded("no json")
