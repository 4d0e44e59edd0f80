"""Behaviour under skew, and the plans that scale depends on."""

import random

from pyspark.sql import functions as F

from feedloom.catalog import feeds
from feedloom.catalog.documents import SAMPLES
from feedloom.operators.dedup import first_per_key
from feedloom.operators.grouping import ordered_blocks
from feedloom.plans import metrics as M
from feedloom.plans.ingest import collection_table
from feedloom.session import table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ordered_blocks_follow_the_order_whatever_the_keys(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("t"), "id")
    blocks = ordered_blocks(rows, "t", "id", blocks=6)
    bounds = blocks.groupBy("_block").agg(F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi"), F.count("id").alias("n")).orderBy("_block").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(bounds, bounds[1:]))
    assert max(b["n"] for b in bounds) < 900


def test_streaks_match_brute_force(spark):
    random.seed(3)
    for bias in (0.2, 0.5, 0.95):
        data = [(i // 3, i, random.choices(["e", "s", "x"], [bias, 1 - bias, 0.2])[0]) for i in range(500)]
        df = spark.createDataFrame(data, "t int, seq long, kind string").select(F.timestamp_seconds("t").alias("ts"), "seq", "kind")
        got = sorted((r["first_seq"], r["length"]) for r in M.streaks(df, F.col("kind") == "e", F.col("kind") == "s").collect())
        want, start, length = [], None, 0
        for _, seq, kind in data:
            if kind == "e":
                start, length = (seq, 1) if length == 0 else (start, length + 1)
            elif kind == "s" and length:
                want.append((start, length))
                length = 0
        if length:
            want.append((start, length))
        assert got == want


def test_dedup_limits_rows_before_the_shuffle(spark):
    rows = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1)], "k string, i int")
    once = first_per_key(rows, ["k"], ["i"])
    assert sorted((r["k"], r["i"]) for r in once.collect()) == [("a", 0), ("b", 1)]
    assert "WindowGroupLimit" in plan(once)


def test_replay_filter_reaches_the_scan(spark, sf_dir):
    import datetime as dt

    from feedloom.plans.replay import ResumePoint, replay

    feed = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    rows = replay(feed, ResumePoint("checkpoint", dt.datetime(2024, 1, 20), False), "ts", "event_id", ["ts"])
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan(rows)


def test_transform_needs_no_python_and_no_shuffle_of_documents(spark, sf_dir):
    sample = SAMPLES["coupons"]
    stored = spark.createDataFrame(sample.messages(spark, sf_dir).limit(5).collect(), sample.messages(spark, sf_dir).schema)
    text = plan(collection_table(stored, "coupons"))
    assert "Exchange" not in text and "Python" not in text


def test_filters_do_not_repeat_the_decoding(spark, sf_dir):
    text = plan(collection_table(feeds.messages(spark, sf_dir), "customers"))
    assert text.count("unbase64") <= 3 * text.count("try_to_binary") + 3
    assert text.lower().count("parsejson(") <= 3


def test_counting_reads_only_its_columns(spark, sf_dir):
    text = plan(M.error_counts(feeds.metric_log(spark, sf_dir)))
    schema = text[text.index("ReadSchema"):]
    assert "props" not in schema.split(">")[0]


def test_row_counts_match_sources(spark, sf_dir):
    assert feeds.change_events(spark, sf_dir).count() == table(spark, sf_dir, "events").count()


def test_archived_objects_are_not_listed_on_the_driver(spark, tmp_path):
    from feedloom.sources.archive import read_archive_files

    for name in ("orders/m1-2024-01-01/insert_x_m1", "orders/m2-2024-01-01/insert_x_m2", "leads/m3-2024-01-01/insert_x_m3"):
        file = tmp_path / "raw" / f"{name}.json"
        file.parent.mkdir(parents=True)
        file.write_text("{}")
    found = read_archive_files(spark, f"{tmp_path}/raw/{{orders,leads}}/m[12]-*/*")
    assert found.inputFiles() == []  # a file source would hold a status of every object
    assert sorted(r["message_id"] for r in found.collect()) == ["m1", "m2"]
    assert read_archive_files(spark, f"{tmp_path}/raw/*/*/*").count() == 3
    assert read_archive_files(spark, (tmp_path / "raw").as_uri() + "/*/*/*").count() == 3


def test_a_task_s_share_of_a_spread_table_is_bounded(spark, tmp_path, monkeypatch):
    from feedloom import session

    spark.range(20000).selectExpr("id", "sha2(CAST(id AS string), 256) AS text").coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    monkeypatch.setattr(session, "SPREAD_BYTES", size // 50)
    dealt = session.spread(rows, rows)
    assert dealt.rdd.getNumPartitions() >= 50 and dealt.count() == 20000


def test_no_task_reads_more_as_the_files_grow(spark, tmp_path):
    from feedloom.session import prepare

    spark.range(128).repartition(128).write.parquet(str(tmp_path / "t"))
    read = prepare(spark).read.parquet(str(tmp_path / "t"))
    files = len(list((tmp_path / "t").glob("*.parquet")))
    assert read.rdd.getNumPartitions() >= files * 4 // 16 > 16  # a file counts as 4 MB at least
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 16 << 20


def test_documents_and_objects_are_copied_once(spark, sf_dir):
    rows = SAMPLES["orders"].messages(spark, sf_dir)
    stored = spark.createDataFrame(rows.limit(5).collect(), rows.schema)
    text = collection_table(stored, "orders")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count('$["document"], VariantType') == 1  # out of the envelope
    assert text.count('$["content"], VariantType') == 1  # out of the document
