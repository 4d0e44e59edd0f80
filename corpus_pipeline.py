"""Training-data pipeline: language, toxicity, near-duplicates, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import langid, mixing, neardup, packing, toxicity
from feedloom.llm.common import reachable, source, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text is rejected where fewer of its trigrams than this belong to any one language.
LEAST_LANGUAGE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a language, and those hardly like any."""
    reachable(spark)
    said = langid.predict(docs, langid.train(docs), *COLUMNS)
    return said.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)).select(*COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that score as toxic."""
    tagged = toxicity.tag(docs, toxicity.train(docs, source(spark, sf_dir, "labels")), *COLUMNS)
    return tagged.filter(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, its smallest id."""
    reachable(spark)
    return neardup.first_of_class(docs).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and cuts sources to their target weights."""
    return mixing.mixed(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mix into sequences."""
    reachable(spark)
    return packing.pack(docs, ids=False)


STAGES = [("language id", language), ("toxicity", toxic), ("minhash near-dedup", near_dedup), ("source mix", source_mix), ("best-fit packing", pack)]

#: Trained models and tokenizers have no SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source(spark, sf_dir, "documents").select(*COLUMNS)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
