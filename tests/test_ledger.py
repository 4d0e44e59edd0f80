"""Tables that take each key once: across dates, partitions, dead jobs and joined index parts."""

import datetime as dt
import os

import pytest
from helpers import encoded, envelope
from pyspark.sql import functions as F

from feedloom.operators import archive as AR
from feedloom.operators import ledger
from feedloom.operators.decode import decode
from feedloom.plans.ingest import collection_table
from feedloom.session import work_dir
from feedloom.sources.messages import MESSAGE_SCHEMA

DAY = dt.datetime(2024, 1, 5, 10, 0, 0)


def deliver(spark, path, *rows, at=DAY):
    """Archives messages (id, payload, publish time) as if they were processed at a time."""
    data = [{"message": {"data": encoded(payload), "messageId": name}, "publishTime": published} for name, payload, published in rows]
    AR.write_archive(AR.archive_rows(decode(spark.createDataFrame(data, MESSAGE_SCHEMA)), F.lit(at)), path)


def stored(spark, path):
    return sorted((r["message_id"], r["ingest_date"].isoformat(), bytes(r["payload"])) for r in ledger.read_committed(spark, path).collect())


@pytest.mark.parametrize("later", [dt.timedelta(seconds=7), dt.timedelta(days=1)])
@pytest.mark.parametrize("payload", ["plain words", {"collection": "orders", "document": {"_id": "1"}}])
def test_an_untimed_message_is_stored_once(spark, payload, later):
    path = work_dir(spark, "raw")
    for at in (DAY, DAY + later):
        deliver(spark, path, ("m1", payload, None), at=at)
    assert [(name, day) for name, day, _ in stored(spark, path)] == [("m1", "2024-01-05")]


def test_another_publish_date_or_collection_makes_no_second_row(spark):
    path = work_dir(spark, "raw")
    first, other = envelope("orders", {"_id": "1"}), envelope("leads", {"_id": "1"}, "update")
    deliver(spark, path, ("m1", first, DAY), ("m1", first, DAY - dt.timedelta(days=2)))
    deliver(spark, path, ("m1", first, DAY + dt.timedelta(days=3)), ("m2", first, DAY))
    deliver(spark, path, ("m1", other, DAY))
    assert [(name, day) for name, day, _ in stored(spark, path)] == [("m1", "2024-01-03"), ("m2", "2024-01-05")]


def test_messages_without_an_id_go_by_their_payload(spark):
    path = work_dir(spark, "raw")
    for at in (DAY, DAY + dt.timedelta(days=1)):
        deliver(spark, path, ("", "one", None), ("", "two", None), ("", "one", None), (None, "two", DAY), at=at)
    assert sorted(p for _, _, p in stored(spark, path)) == [b"one", b"two"]
    assert ledger.read_committed(spark, path).select("path").distinct().count() == 2


@pytest.mark.parametrize("step", ["_write_keys", "_commit"])
def test_a_dead_job_leaves_nothing_that_counts(spark, monkeypatch, step):
    path = work_dir(spark, "raw")
    deliver(spark, path, ("m1", "one", DAY))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(ledger, step, dies)
        with pytest.raises(RuntimeError):
            deliver(spark, path, ("m1", "one", DAY), ("m2", "two", DAY))
    assert [name for name, _, _ in stored(spark, path)] == ["m1"]
    for _ in range(2):
        deliver(spark, path, ("m1", "one", DAY), ("m2", "two", DAY))
    assert [name for name, _, _ in stored(spark, path)] == ["m1", "m2"]


def test_joined_index_parts_still_know_every_key(spark):
    path = work_dir(spark, "raw")
    for i in range(4):
        deliver(spark, path, (f"m{i}", "x", DAY), (f"m{i + 1}", "x", DAY))
    ledger.compact_keys(spark, path)
    assert sum(name.startswith("_batch=") for name in os.listdir(f"{path}/_keys")) == 1
    deliver(spark, path, *[(f"m{i}", "x", DAY + dt.timedelta(days=9)) for i in range(7)])
    assert [name for name, _, _ in stored(spark, path)] == [f"m{i}" for i in range(7)]
    ledger.compact_keys(spark, path)
    assert ledger.known_keys(spark, path).count() == 7


def test_a_copy_naming_another_operation_or_day_is_no_second_row(spark):
    path = work_dir(spark, "table")

    def write(operation, stamp):
        body = {**envelope("coupons", {"_id": "c1"}, operation), "timestamp": stamp}
        rows = spark.createDataFrame([{"message": {"data": encoded(body), "messageId": "m1"}}], MESSAGE_SCHEMA)
        return AR.write_collection_table(collection_table(rows, "coupons"), path)

    assert [write("insert", "2024-01-01T00:00:00Z"), write("update", "2024-02-01T00:00:00Z"), write("insert", None)] == [1, 0, 0]
    assert [r["_operation"] for r in ledger.read_committed(spark, path).collect()] == ["insert"]


def test_digests_tell_keys_and_nulls_apart(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), (None, None), ("", None), ("a", "b"), ("ab", None), ('a","k1":"b', None)], "x string, y string")
    assert rows.select(ledger.digest("x", "y").alias("d")).distinct().count() == rows.count()


def test_reading_a_table_without_commits(spark, tmp_path):
    assert ledger.read_committed(spark, str(tmp_path / "none"), "a int").count() == 0
    nothing = spark.createDataFrame([], "k string, p int")
    assert ledger.add_once(nothing, str(tmp_path / "t"), ledger.digest("k"), ["p"], ["p"]) == 0


def test_the_index_is_not_shuffled_for_a_small_batch(spark):
    path = work_dir(spark, "raw")
    deliver(spark, path, ("m1", "one", DAY))
    batch = work_dir(spark, "batch")
    ledger.known_keys(spark, path).write.parquet(batch)
    met = ledger.known_keys(spark, path).join(spark.read.parquet(batch), "_key", "left_semi")
    met.collect()
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ReadSchema: struct<_key:binary>" in plan


def test_rows_that_a_table_holds_are_not_mapped_again(spark, monkeypatch):
    from feedloom.plans import ingest

    mapped, whole = [], ingest.transform_collection
    monkeypatch.setattr(ingest, "transform_collection", lambda rows, name, *a: mapped.append((name, rows.count())) or whole(rows, name, *a))
    out = work_dir(spark, "tables")

    def write(*names):
        sent = [(n, envelope("coupons" if n > "m" else "nowhere", {"_id": n, "createdAt": "never"})) for n in names]
        rows = [{"message": {"data": encoded(body), "messageId": n}} for n, body in sent]
        ingest.write_all_tables(spark.createDataFrame(rows, MESSAGE_SCHEMA), out, work_dir(spark, "routed"), F.lit(DAY))

    write("m1", "m2", "a1")
    write("m2", "m1", "m1", "a1")
    write("m1", "m3", "a1", "a2")
    assert mapped == [("coupons", 2), ("coupons", 1)]
    ids = lambda path, name: sorted(r[name] for r in ledger.read_committed(spark, path).collect())
    assert ids(f"{out}/coupons", "pk_coupon") == ["m1", "m2", "m3"] and ids(f"{out}/_skipped", "message_id") == ["a1", "a2"]
    assert ledger.known_keys(spark, f"{out}/coupons").distinct().count() == ledger.known_keys(spark, f"{out}/coupons").count() == 3
    cast = ingest.read_drift(spark, out, ["coupons"]).filter("message LIKE 'TYPE%' AND message_id IS NOT NULL")
    assert sorted(r["message_id"] for r in cast.collect()) == ["m1", "m2", "m3"]
