"""Tables that take every key once, in whichever partition a copy of it would land.

Below a table's path lie

* ``_batch=<attempt>/...``: the rows, by the attempt that wrote them, in their own partitions;
* ``_keys/_batch=<attempt>``: an index, 16 bytes a row: the digests of these rows' keys;
* ``_commits``: one line for each attempt that went through.

An attempt writes its rows first, then its part of the index, and its line last; nobody reads an attempt without a
line.  A job that dies on the way therefore leaves nothing behind that counts, and its next run writes the rows as if
for the first time.  Keys are looked up in the index alone, whatever the date, collection or operation of a row: a
batch's keys are sent to the index (by broadcast, where Spark measures them as small), not the index to them.

A batch's rows are evaluated once: they are written before they are compared, and written anew without the known ones
only where there are any.  Where rows bring their key before anything is made of them, ``unseen`` takes the known ones
out first, and none of these is evaluated.  One writer at a time; ``compact_keys`` joins the index parts of many small
batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import first_per_key

#: ``index`` marks a line that only joins parts of the index; ``replaces`` names what a line stands in for.
COMMIT = "attempt string, index boolean, replaces array<string>"


def digest(*keys: str | Column) -> Column:
    """16 bytes that stand for the keys together; nulls are keys of their own."""
    named = F.struct(*[(F.col(k) if isinstance(k, str) else k).alias(f"k{i}") for i, k in enumerate(keys)])
    return F.unhex(F.substring(F.sha2(F.to_json(named), 256), 1, 32))


def write_parts(df: DataFrame, path: str, mode: str, *parts: str) -> None:
    """Partitioned Parquet with few, evenly sized files.

    The rebalance hint lets AQE cut the shuffle by measured size: small partitions share a
    task, and a partition holding much of the data is split over many.
    """
    columns = [F.col(p) for p in parts]
    df.hint("rebalance", *columns).write.mode(mode).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*parts).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes data that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(COMMIT).json(f"{path}/_commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def _commit(spark: SparkSession, path: str, attempt: str, replaces: list[str], index: bool = False) -> None:
    """One line, in a file that appears whole or not at all."""
    line = spark.range(1).select(
        F.lit(attempt).alias("attempt"), F.lit(index).alias("index"),
        F.lit(replaces).cast("array<string>").alias("replaces"),
    )
    line.coalesce(1).write.mode("append").json(f"{path}/_commits")


def _whole(spark: SparkSession, path: str) -> DataFrame:
    """Attempts whose rows count."""
    lines = _lines(spark, path).filter("NOT index")
    return lines.join(lines.select(F.explode("replaces").alias("attempt")), "attempt", "left_anti").select("attempt").distinct()


def _live_parts(spark: SparkSession, path: str) -> DataFrame:
    """Attempts whose part of the index counts."""
    lines = _lines(spark, path)
    gone = lines.select(F.explode("replaces").alias("attempt"))
    return lines.join(gone, "attempt", "left_anti").select(F.col("attempt").alias("_batch"))


def known_keys(spark: SparkSession, path: str) -> DataFrame:
    """``_key`` of every committed row."""
    try:
        keys = spark.read.schema("_key binary, _batch string").parquet(f"{path}/_keys")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "_key binary")
    return keys.join(_live_parts(spark, path), "_batch", "left_semi").select("_key")


def read_committed(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The table's rows; with a ``schema``, no rows where nothing was ever committed.

    A table that was not written here, and so has no attempts, is read as it stands.
    """
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
    if "_batch" not in rows.columns:
        return rows
    whole = _whole(spark, path).select(F.col("attempt").alias("_batch"))
    return rows.join(whole, "_batch", "left_semi").drop("_batch", "_key")


def _new_attempt() -> str:
    return f"b{uuid.uuid4().hex}"  # a letter first, so that no folder name reads as a number


def _write_keys(keys: DataFrame, path: str, attempt: str) -> None:
    keys.sortWithinPartitions("_key").write.parquet(f"{path}/_keys/_batch={attempt}")


@contextmanager
def unseen(rows: DataFrame, path: str, key: Column) -> Iterator[DataFrame | None]:
    """The rows whose key the table does not hold yet, as long as the context lasts; None where it holds them all.

    Only keys are read to tell: of the batch, and those of the index that the batch names.
    """
    keyed = rows.withColumn("_key", key)
    met = known_keys(rows.sparkSession, path).join(keyed.select("_key"), "_key", "left_semi").persist()
    try:
        if not met.limit(1).count():
            yield rows
        elif not keyed.select("_key").join(met, "_key", "left_anti").limit(1).count():
            yield None
        else:
            yield keyed.join(met, "_key", "left_anti").drop("_key")
    finally:
        met.unpersist()


def add_once(rows: DataFrame, path: str, key: Column, order: list[str], parts: list[str], fresh: bool = False) -> int:
    """Adds the first row (by ``order``) of each key that the table does not hold yet; returns how many.

    ``fresh`` says that every key occurs once in ``rows`` and that those of the table were taken out by ``unseen``.
    """
    spark, attempt = rows.sparkSession, _new_attempt()
    place = f"{path}/_batch={attempt}"
    keyed = rows.withColumn("_key", key)
    once = keyed if fresh else first_per_key(keyed, ["_key"], order)
    write_parts(once, place, "errorifexists", *parts)
    mine = spark.read.schema(once.schema).parquet(place)
    if not fresh:
        met = known_keys(spark, path).join(mine.select("_key"), "_key", "left_semi").persist()
        if met.limit(1).count():
            attempt, first = _new_attempt(), place
            place = f"{path}/_batch={attempt}"
            write_parts(mine.join(met, "_key", "left_anti"), place, "errorifexists", *parts)
            remove(spark, first)
            mine = spark.read.schema(once.schema).parquet(place)
        met.unpersist()
    added = mine.count()
    if added:
        _write_keys(mine.select("_key"), path, attempt)
        _commit(spark, path, attempt, [])
    else:
        remove(spark, place)
    return added


def derive_once(spark: SparkSession, source: str, target: str, derive, parts: list[str]) -> None:
    """Writes ``derive(rows)`` of each committed attempt of ``source`` to ``target``, under the same attempt.

    Attempts that ``target`` lacks are caught up with, so a job that dies in between loses nothing and a second
    run adds nothing.
    """
    due = _whole(spark, source).join(_lines(spark, target), "attempt", "left_anti")
    for line in due.collect():  # those since the last run: one, unless a job died
        attempt = line["attempt"]
        put(derive(spark.read.parquet(source).filter(F.col("_batch") == attempt).drop("_batch", "_key")), target, attempt, parts)


def put(rows: DataFrame, path: str, attempt: str, parts: list[str], replaces: list[str] | None = None) -> None:
    """Writes rows as the attempt of that name; the same attempt again takes the place of the first."""
    spark = rows.sparkSession
    write_parts(rows, f"{path}/_batch={attempt}", "overwrite", *parts)
    _commit(spark, path, attempt, replaces or [])


def merge(spark: SparkSession, path: str, combine, parts: list[str]) -> None:
    """Replaces all committed rows by ``combine`` of them, in one step for readers."""
    old = [r["attempt"] for r in _whole(spark, path).collect()]  # one name a batch since the last time
    if len(old) > 1:
        put(combine(read_committed(spark, path)), path, _new_attempt(), parts, old)
        for attempt in old:
            remove(spark, f"{path}/_batch={attempt}")


def compact_keys(spark: SparkSession, path: str) -> None:
    """Joins the parts of the index into one; the rows stay where they are."""
    parts = [r["_batch"] for r in _live_parts(spark, path).collect()]  # one name a batch since the last time
    if len(parts) > 1:
        attempt = _new_attempt()
        _write_keys(known_keys(spark, path).repartitionByRange("_key"), path, attempt)
        _commit(spark, path, attempt, parts, index=True)
        for part in parts:
            remove(spark, f"{path}/_keys/_batch={part}")
