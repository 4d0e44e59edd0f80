"""The corpus pipeline against its stages applied one by one in plain Python."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from feedloom.llm import langid, neardup, packing, queries, toxicity
from feedloom.llm.common import source, words


def test_pipeline_matches_its_stages(spark, sf_dir):
    docs = [r.asDict() for r in source(spark, sf_dir).collect()]
    frame = source(spark, sf_dir)
    filters = langid.train(frame)
    kept = [d for d in docs for said, sure in [langid.decide(d["text"], filters)] if said != "und" and sure >= corpus_pipeline.LEAST_LANGUAGE]
    frame = spark.createDataFrame(kept, frame.schema)
    field = toxicity.train(frame, source(spark, sf_dir, "labels"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.tag(frame, field, "doc_id").collect()}
    kept = [d for d in kept if scores[d["doc_id"]] < toxicity.THRESHOLD]
    classes = {r["doc_id"]: r["kept"] for r in neardup.near_duplicates(spark.createDataFrame(kept, frame.schema)).collect()}
    kept = [d for d in kept if classes[d["doc_id"]]]
    mixed = [r.asDict() for r in corpus_pipeline.source_mix(spark, spark.createDataFrame(kept, frame.schema), sf_dir).collect()]
    assert abs(sum(len(words(d["text"])) for d in mixed) - 1.5 * sum(len(words(d["text"])) for d in kept)) <= len({d["source"] for d in kept})
    encode = packing.Encoder(packing.tokenizer_path())
    want = Counter()
    for d in mixed:
        want[d["doc_id"]] += len(encode(d["text"])) // 4 + 1
    got, at = Counter(), {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got[r["doc_id"]] += r["length"]
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for parts in at.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= 2048


def test_stages_take_empty_tables_and_nulls(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], schema)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "word " * 60, None, None, 300), (2, "one two", "en", "s", 7)], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
        stage(spark, odd, sf_dir).collect()


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in queries.QUERIES.items() if sql))
def test_query_matches_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    run, sql = queries.QUERIES[name]
    want, got = con.execute(sql).to_arrow_table().to_pylist(), [r.asDict() for r in run(spark, sf_dir).collect()]
    key = lambda r: tuple(str(r[c]) for c in sorted(r))
    assert sorted(map(key, got)) == sorted(map(key, want))
