"""Packing by patterns: few-document length patterns, fitted to the length histogram by non-negative least squares.

Documents become pieces of at most ``capacity`` tokens.  Only their histogram (one count per length, whatever
the corpus) reaches the driver.  There, patterns of two to four lengths that fill a sequence exactly are given
repeat counts by non-negative least squares (multiplicative updates, which keep counts non-negative), counts are
rounded down, and the residue is packed by best-fit patterns of its own: the longest length left, filled up with
the longest that still fits, repeated as often as the histogram allows.  The plan is a list of intervals: ranks
``from..`` within a length go to sequence ``base + (rank - from)`` at a fixed offset.  Its size depends on the
capacity alone.  Pieces are ranked within their length by salted counts, so no length meets in one task.

Defined results: null text is the empty document, a piece of the end id alone; longer documents are cut so that
every piece but the first is full; rows that repeat are packed each; no rows, no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import LATIN, MARKS, Recent, chunks, slices, stage

CAPACITY, END_ID = 2048, 0
TOKENIZER = "byte_bpe_50k.json"
#: Fixed: the byte-level tokenizer's own split of a text into parts that it encodes one by one, for the characters it is certain of.
PARTS = re.compile(rf" ?[{LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{MARKS}]+| ?[0-9]+|\s+(?!\S)|\s+")
UNCERTAIN = rf"[^{LATIN}{MARKS}0-9 \t-\r]"
#: A space between two other characters begins a part, whatever stands around it.
BORDER, UNITS = re.compile(r"(?<=\S) (?=\S)"), re.compile(r"(?<=\S)(?= \S)")
LONG = 1 << 20
#: Fixed by rule: the letter by which the byte-level model knows each byte, itself if it is printable.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = dict(zip([*PRINTABLE, *(b for b in range(256) if b not in PRINTABLE)], [*PRINTABLE, *range(256, 324)], strict=True))
SPACE = chr(BYTES[32])


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian 32-bit bytes.

    Texts are cut into the tokenizer's parts; where a character is not certain, the word with it stays whole.  Parts
    met before come from a bounded cache that keeps the frequent ones.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge = self.tokenizer.model.tokenize
        self.uncertain = re.compile("|".join([UNCERTAIN, *special])).search
        self.cache = Recent(self.encode, 128 << 20)

    def whole(self, text: str) -> bytes:
        """Ids by the tokenizer's whole way."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, part: str) -> bytes:
        """Ids of a part; a certain one is a word of the model as it stands."""
        if self.uncertain(part):
            return self.whole(part)
        plain = part.isascii() and part.isprintable()  # then the space alone has another letter
        return array("I", [t.id for t in self.merge(part.replace(" ", SPACE) if plain else part.encode().decode("latin-1").translate(BYTES))]).tobytes()

    def short(self, text: str) -> bytes:
        """Ids of a text of bounded size."""
        if self.uncertain(text):
            parts = [p for u in UNITS.split(text) for p in ([u] if self.uncertain(u) else PARTS.findall(u))]
        else:
            parts = PARTS.findall(text)
        return b"".join(map(self.cache.__getitem__, parts))

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.short, chunks(text, BORDER, LONG)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, their ids' crc32, and the ids unless ``ids`` is false."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encode = encoder(path)
        for part in slices(batches):
            rows = []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                coded = encode(text or "") + end
                n, start, piece = len(coded) // 4, 0, 0
                while start < n:
                    stop = start + ((n - start) % capacity or capacity)
                    held = coded[4 * start : 4 * stop]
                    rows.append((doc, piece, start, stop - start, zlib.crc32(held), np.frombuffer(held, "<i4") if ids else None))
                    start, piece = stop, piece + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)][: 6 if ids else 5], names=names[: 6 if ids else 5])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def patterns(capacity: int) -> list[tuple[int, ...]]:
    """Exact fills by two to four lengths: all pairs, triples on a grid of distances, and paired pairs."""
    found = [(capacity,)] + [(capacity - a, a) for a in range(1, capacity // 2 + 1)]
    step = max(1, capacity // 64)
    for a in range(1, capacity // 3 + 1):
        found += [(capacity - a - b, b, a) for b in range(a, (capacity - a) // 2 + 1, step)]
    found += [(capacity // 2 - a, capacity // 2 - a, a, a) for a in range(1, capacity // 4 + 1)] if capacity % 2 == 0 else []
    return found


def fit(histogram: np.ndarray, shapes: list[tuple[int, ...]], rounds: int = 300) -> np.ndarray:
    """Non-negative repeat counts x of the patterns that bring A x near the histogram in least squares."""
    rows = np.concatenate([np.array(s) for s in shapes])
    columns = np.repeat(np.arange(len(shapes)), [len(s) for s in shapes])
    wanted = np.bincount(columns, histogram[rows], len(shapes))
    x = np.where(np.minimum.reduceat(histogram[rows], np.r_[0, np.cumsum([len(s) for s in shapes])[:-1]]) > 0, wanted / len(shapes) + 1e-9, 0.0)
    for _ in range(rounds):
        made = np.bincount(rows, x[columns], len(histogram))
        x = x * wanted / np.maximum(np.bincount(columns, made[rows], len(shapes)), 1e-12)
    return x


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and whole repeat counts that use up the histogram exactly (``histogram[n]``: pieces of length n)."""
    left, chosen = histogram.astype(np.int64).copy(), []

    def use(shape, times):
        if times > 0:
            chosen.append((shape, int(times)))
            np.subtract.at(left, list(shape), int(times))

    use((capacity,), left[capacity])
    if left.any():
        shapes = patterns(capacity)[1:]
        x = fit(left.astype(float), shapes)
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 1:
                break
            shape = shapes[k]
            use(shape, min(int(x[k]), *(left[n] // shape.count(n) for n in shape)))
    while left.any():  # best-fit patterns for the residue: each step uses up a length
        shape, room = [], capacity
        while room:
            fits = left[: room + 1].copy()
            for n in shape:
                if n <= room:
                    fits[n] -= 1
            open_ = np.flatnonzero(fits > 0)
            if not len(open_):
                break
            shape.append(int(open_[-1]))
            room -= shape[-1]
        use(tuple(shape), min(left[n] // shape.count(n) for n in shape))
    return chosen


def intervals(chosen: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY):
    """Per length: first ranks, sequence bases and offsets of its runs, as flat arrays with bounds by length."""
    runs, used, base = [[] for _ in range(capacity + 1)], [0] * (capacity + 1), 0
    for shape, times in chosen:
        at = 0
        for n in shape:
            runs[n].append((used[n], base, at))
            used[n] += times
            at += n
        base += times
    bounds = np.cumsum([0, *map(len, runs)])
    flat = np.array([r for of in runs for r in of], np.int64).reshape(-1, 3)
    return bounds, flat[:, 0].copy(), flat[:, 1].copy(), flat[:, 2].copy()


def ranked(cut: DataFrame) -> DataFrame:
    """``rank`` within each length, from 0: counts by (length, salt) give offsets, and each salt ranks its own."""
    salts = max(4, 1 << max(0, cut.count().bit_length() // 2 - 1))  # about half the square root of the pieces
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count("piece").alias("n"))
    before = counts.select("length", "salt", F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return salted.withColumn("own", own).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own")).drop("salt", "own", "before")


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Places of stored pieces: their columns, sequence_id, and the offset there."""
    counts = cut.groupBy("length").count().collect()  # one row per length, at most ``capacity``
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts:
        histogram[row["length"]] = row["count"]
    sent = cut.sparkSession.sparkContext.broadcast(intervals(plan(histogram, capacity), capacity))

    def place(batches):
        bounds, first, base, offset = sent.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = np.empty(len(rank), np.int64)
            for n in np.unique(length):
                own = length == n
                run[own] = bounds[n] + np.searchsorted(first[bounds[n] : bounds[n + 1]], rank[own], "right") - 1
            keep = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(base[run] + rank - first[run]), pa.array(offset[run])], names=[*columns, "sequence_id", "offset"])

    columns = cut.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return ranked(cut).select(*columns, "rank").mapInArrow(place, schema)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True) -> DataFrame:
    """Tokenises, cuts and packs documents: one row per piece (see ``pieces`` and ``packed``)."""
    made = pieces(docs, path or tokenizer_path(), capacity, end_id, ids)
    if not ids:
        return packed(stage(made, "pack-pieces"), capacity)
    cut = stage(made.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")  # written, so both readers see one number
    return cut.join(packed(cut.drop("ids"), capacity).select("row", "sequence_id", "offset"), "row").drop("row")


def sequences(placed: DataFrame) -> DataFrame:
    """Token ids of every sequence, its pieces in order (a sequence holds ``capacity`` ids at most)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
