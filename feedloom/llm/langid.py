"""Language identification by n-gram filters: one Bloom filter per language, stored bit-sliced.

Slice ``p`` of the table holds one bit per language, so the AND of an n-gram's slices is the bitmask of all
languages that contain it.  A text's trigrams are looked up at once, the bits are counted per language, and
counts are corrected for the false positives each filter has at its fill: ``(hits - n f) / (1 - f)``.  The most
hits decide; the score is the corrected share of the text's trigrams that the chosen language contains.

Trigrams run over lower-cased letters, words padded by one space.  A language contains a trigram whose share of
its training trigrams is at least ``MIN_SHARE`` and at least a ``CONTRAST`` of the share in any other language,
so passages in another language do not enter.  At most ``1 / MIN_SHARE`` trigrams per language reach the driver.

Training rows are those with a language and text and crc32(id) mod 3 other than 1; of these a sample of about
``SAMPLE`` rows is read, chosen by another hash of the id.  Predictions use the text alone and the whole of it.

Defined results: null text or text without letters is ``und`` with score 0; equal counts go to the first
language in order; without training rows every text is ``und``; null ids are not held out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import drawn, letters, slices

SAMPLE, MIN_SHARE, CONTRAST, HASHES, SLOTS = 20_000, 2e-5, 0.05, 3, 1 << 19
UNKNOWN = "und"
_SPACE = np.uint32(32)
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class Filters(NamedTuple):
    """Languages, the slices (one row of bitmasks per 64 languages), and each language's false-positive rate."""

    languages: list[str]
    slices: np.ndarray
    false: np.ndarray


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string")) % 3 == 1, F.lit(False))


def trigrams(text: str | None) -> np.ndarray:
    """Codes of a text's trigrams, repeats included; 21 bits a character."""
    if not text:
        return np.empty(0, np.uint64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    run = np.concatenate(([_SPACE], np.where(letters()[points], points, _SPACE), [_SPACE]))
    run = run[np.r_[True, (run[1:] != _SPACE) | (run[:-1] != _SPACE)]].astype(np.uint64)
    return (run[:-2] << np.uint64(42)) | (run[1:-1] << np.uint64(21)) | run[2:] if len(run) >= 3 else np.empty(0, np.uint64)


def positions(codes: np.ndarray, k: int) -> np.ndarray:
    mixed = (codes ^ (codes >> np.uint64(31))) * _SEEDS[k]
    return ((mixed ^ (mixed >> np.uint64(32))) * _SEEDS[-1] >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def training_counts(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Trigram counts by language of the training sample."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    share = min(1.0, sample / max(1, rows.count()))
    chosen = rows.filter(drawn("langid", share))

    def count(batches):
        for part in slices(batches, rows=2048):
            by = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                by.setdefault(lang, []).append(trigrams(text))
            for lang, found in by.items():
                codes, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "code", "n"])

    return chosen.select("lang", "text").mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, sample: int = SAMPLE, min_share: float = MIN_SHARE, contrast: float = CONTRAST) -> Filters:
    counts = training_counts(docs, sample)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    shares = counts.join(totals, "lang").withColumn("share", F.col("n") / F.col("all")).filter(F.col("share") >= min_share)
    found = shares.withColumn("most", F.max("share").over(W.partitionBy("code"))).filter(F.col("share") >= contrast * F.col("most")).select("lang", "code").collect()
    languages = sorted({r["lang"] for r in found})
    table = np.zeros((max(1, -(-len(languages) // 64)), SLOTS), np.uint64)
    false = np.zeros(len(languages))
    for i, lang in enumerate(languages):
        codes = np.array([r["code"] for r in found if r["lang"] == lang], np.int64).astype(np.uint64)
        bit = np.uint64(1 << (i % 64))
        for k in range(HASHES):
            table[i // 64, positions(codes, k)] |= bit
        false[i] = (np.count_nonzero(table[i // 64] & bit) / SLOTS) ** HASHES
    return Filters(languages, table, false)


def decide(text: str | None, filters: Filters) -> tuple[str, float]:
    codes = trigrams(text)
    if not len(codes) or not filters.languages:
        return UNKNOWN, 0.0
    at = [positions(codes, k) for k in range(HASHES)]
    hits = np.empty(len(filters.languages))
    for row, of in enumerate(filters.slices):
        mask = of[at[0]]
        for p in at[1:]:
            mask &= of[p]
        for i in range(row * 64, min(len(hits), row * 64 + 64)):
            hits[i] = np.count_nonzero(mask & np.uint64(1 << (i % 64)))
    sure = np.clip((hits - len(codes) * filters.false) / (1 - filters.false), 0, len(codes))
    best = int(sure.argmax())
    return filters.languages[best], float(sure[best] / len(codes))


def predict(docs: DataFrame, filters: Filters, *keep: str) -> DataFrame:
    """lang_pred and score of every row, beside the columns to keep."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def tag(batches):
        for part in slices(batches):
            said = [decide(t, sent.value) for t in part.column("text").to_pylist()]
            columns = [part.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())], names=[*keep, "lang_pred", "score"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(tag, f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    said = predict(docs, train(docs, sample), "doc_id")
    return said.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
