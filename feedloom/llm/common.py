"""Helpers of the training-data operators: words, bounded slices of Arrow batches, staged tables."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import table, work_dir

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: A word is a run without the six ASCII white spaces; bytes.split() cuts at just these.
WORD = r"[^\x20\x09-\x0D]+"
#: Letters and marks that tokenizers' splits of any version agree on: İ, whose lower case is two characters, is left out.
LATIN, MARKS = "A-Za-zÀ-ÖØ-öø-įı-ɏ", r"!-/:-@\[-`{-~"
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z alone lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", rows: int = 512, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that Python holds at most ``rows`` texts or about ``limit`` bytes at once."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(size.tolist()):
            if i > start and (held + n > limit or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


class Memo(dict):
    """A bounded cache of a function over words; it empties when full, so memory does not grow with the data."""

    def __init__(self, function, limit: int = 500_000):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.function(word)
        return value


class Recent(dict):
    """A cache of about ``limit`` bytes in two generations: when the young one, the dict itself, is full it becomes the old one.

    A key met again moves to the young one, so frequent keys outlive any number of rare ones.
    """

    def __init__(self, function=None, limit: int = 64 << 20, longest: int = 256):
        super().__init__()
        self.function, self.limit, self.longest = function, limit, longest
        self.old, self.held = {}, 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        self._put(key, value)
        return value

    def values_of(self, keys: Iterable, compute) -> dict:
        """Values of ``keys``; all that are in neither generation come from one call ``compute(list)``."""
        young, keys = self.get, set(keys)
        found, missed = {k: v for k in keys if (v := young(k)) is not None}, []
        for key in keys - found.keys():
            value = self.old.get(key)
            if value is None:
                missed.append(key)
            else:
                found[key] = value
                self._put(key, value)
        for key, value in zip(missed, compute(missed) if missed else (), strict=True):
            found[key] = value
            self._put(key, value)
        return found

    def _put(self, key, value) -> None:
        size = len(key) + (len(value) if isinstance(value, bytes) else 8)
        if size > self.longest:
            return
        if self.held >= self.limit // 2:
            self.old, self.held = dict(self), 0
            self.clear()
        self[key] = value
        self.held += size + 150  # what a key, a value and their place in a dict take beside their letters


def chunks(text: str, border: re.Pattern, size: int = 1 << 20) -> Iterator[str]:
    """The whole text in pieces of at least ``size`` characters, cut ahead of matches of ``border`` alone."""
    start = 0
    while len(text) - start > size and (cut := border.search(text, start + size)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back: lineage ends, lost executors cost nothing."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read._staged_path = path
    return read


def unstage(*tables: DataFrame) -> None:
    """Removes staged tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def reachable(spark: SparkSession) -> SparkSession:
    """Puts this package on the path of Python workers whose driver imported it by a path of its own.

    Arrow batches are kept to few rows as well, since a row here is a whole text.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in (paths := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def source(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return table(reachable(spark), sf_dir, name)


def drawn(label: str, share: float) -> Column:
    """Whether a row's id is in a sample of ``share`` of the ids; fine enough for shares of any corpus."""
    return F.pmod(F.xxhash64(F.lit(label), "doc_id"), F.lit(1 << 40)) < round(share * (1 << 40))


def word_count(column: str = "text"):
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
