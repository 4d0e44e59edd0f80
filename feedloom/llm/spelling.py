"""Spelling variants by dense prefix-suffix tiles: words one edit apart, grouped under their frequent form.

Words are runs of Latin letters of whole texts, counted in the tasks and summed by one shuffle.  Of two words one
edit apart, the longer one having m letters, common prefix and common suffix add up to at least m - 1.  With
k = m div 3 they share a first part of 2k letters, or a last one, or k letters at either end: three tiles for each m,
which a word joins as the longer (its own length) and as the shorter (one more).  In a task, the words of a tile are
the rows of a padded matrix of code points; columns are compared densely, block by block, and give the lengths of
all common prefixes and suffixes at once.  A pair is counted in the first of its tiles.  Tiles above a block's size
are dealt out as pairs of blocks, and only a word's count of near words and its best one leave a task.

Defined results: null and empty texts have no words; a null id counts as an empty string in the damage; rows that
repeat count again; ties go to the smallest word in code-point order; a text of any length is read run by run;
columns other than ``doc_id`` and ``text`` are ignored; no words, no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import LOWER, slices, stage, unstage

LEAST_LETTERS, LEAST_COUNT, RATIO, DAMAGE = 7, 2, 10, 31
BLOCK, CELLS = 1024, 1 << 20
FLUSH = 200_000
TILE = ("m", "side", "tile", "lo", "hi")


def damaged(run: str, prefix: int, every: int = DAMAGE) -> str:
    """The run, or without one letter where ``every`` divides its hash (``prefix``: crc32 of ``<doc_id>:``)."""
    h = zlib.crc32(run.encode(), prefix)
    if every and h % every == 0:
        at = h % len(run)
        return run[:at] + run[at + 1 :]
    return run


def words(docs: DataFrame, least: int = LEAST_LETTERS, times: int = LEAST_COUNT, every: int = DAMAGE) -> DataFrame:
    """``word, n``: words of at least ``least`` letters that occur at least ``times`` times."""
    run = re.compile(f"[A-Za-z\\u00C0-\\u00FF]{{{least},}}")  # shorter runs cannot become words

    def told(total):
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    def count(batches):
        total = Counter()
        for part in slices(batches):
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                lowered = text.encode().translate(LOWER).decode()
                for found, n in Counter(m[0] for m in run.finditer(lowered)).items():
                    word = damaged(found, prefix, every)
                    if len(word) >= least:
                        total[word] += n
                if len(total) > FLUSH:
                    yield told(total)
                    total = Counter()
        yield told(total)

    counted = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def tiled(counted: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every word once in each of its tiles and pairs of blocks, these in order."""
    letters = F.length("word")
    classes = F.explode(F.array(letters, letters + 1)).alias("m")
    k = F.expr("m div 3").cast("int")
    end = lambda n: F.substring(F.col("word"), letters - n + 1, n)
    start = lambda n: F.substring(F.col("word"), F.lit(1), n)
    sides = F.array(F.struct(F.lit(0).alias("side"), start(2 * k).alias("key")), F.struct(F.lit(1).alias("side"), F.concat(start(k), end(k)).alias("key")), F.struct(F.lit(2).alias("side"), end(2 * k).alias("key")))
    keyed = counted.select("word", "n", classes).select("word", "n", "m", F.explode(sides).alias("s"))
    keyed = keyed.select("word", "n", "m", "s.side", F.xxhash64("s.key").alias("tile"))
    rows = F.greatest(F.lit(16), F.least(F.lit(block), F.lit(CELLS) / F.col("m")))  # long words, fewer rows
    large = keyed.groupBy("m", "side", "tile").count().filter(F.col("count") > rows)
    sized = keyed.join(large, ["m", "side", "tile"], "left")
    blocks = F.greatest(F.lit(1), F.ceil(F.coalesce("count", F.lit(1)) / rows)).cast("int")
    dealt = sized.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("m", "side", "tile", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "word", "n")
    return dealt.repartition(*TILE).sortWithinPartitions(*TILE, "own", "word")


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of common prefixes of all rows of ``a (t, g, width)`` with those of ``b (t, h, width)``, tile by tile."""
    run = np.ones((a.shape[0], a.shape[1], b.shape[1]), bool)
    length = np.zeros(run.shape, np.uint8 if a.shape[2] < 256 else np.int32)
    for c in range(min(a.shape[2], b.shape[2])):
        run &= a[:, :, None, c] == b[:, None, :, c]
        if not run.any():
            break
        length += run
    return length


class Tiles:
    """The tiles of a run of rows: words as latin bytes (which all their letters have), and where each tile's two blocks lie."""

    def __init__(self, rows: pa.Table):
        column = lambda name: rows.column(name).to_numpy()
        self.words = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
        self.n, self.letters = column("n"), np.array([len(w) for w in self.words])
        m, side, tile, lo, hi, own = (column(c) for c in (*TILE, "own"))
        new = np.ones(len(m), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in (m, side, tile, lo, hi)], axis=0)
        self.start = np.flatnonzero(new)
        stop = np.append(self.start[1:], len(m))
        low = np.add.reduceat((own == lo).astype(np.int64), self.start)
        one = lo[self.start] == hi[self.start]
        self.m, self.side, self.one, self.a_size = m[self.start].astype(np.int64), side[self.start], one, low
        self.b_start = np.where(one, self.start, self.start + low)
        self.b_size = np.where(one, low, stop - self.start - low)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows and their near rows, of tiles stacked by size and width."""
        power = lambda x: 1 << np.ceil(np.log2(np.maximum(x, 1))).astype(np.int64)
        wanted = np.flatnonzero((self.a_size > 0) & (self.b_size > 0) & ~(self.one & (self.a_size < 2)))
        shape = np.stack([power(self.a_size), power(self.b_size), power(self.m)], 1)[wanted]
        found = [(np.zeros(0, np.int64),) * 2]
        for g, h, width in np.unique(shape, axis=0).tolist():
            alike = wanted[(shape == (g, h, width)).all(1)]
            step = max(1, min(CELLS // (g * h), 16 * CELLS // (width * (g + h))))
            for i in range(0, len(alike), step):
                found += self._stack(alike[i : i + step], g, h)
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def _stack(self, tiles: np.ndarray, g: int, h: int) -> list:
        rows_a, a = self._block(self.start[tiles], self.a_size[tiles], g)
        rows_b, b = self._block(self.b_start[tiles], self.b_size[tiles], h)
        la, lb = (np.where(r >= 0, self.letters[r], 0) for r in (rows_a, rows_b))
        shorter, longer = np.minimum(la[:, :, None], lb[:, None, :]), np.maximum(la[:, :, None], lb[:, None, :])
        head, tail = (np.minimum(common(x, y), shorter) for x, y in zip(a, b, strict=True))
        m, side = self.m[tiles][:, None, None], self.side[tiles][:, None, None]
        close = (shorter >= m - 1) & (longer == m) & (head + tail >= m - 1)
        if g == h:  # a row is not its own near word
            close &= rows_a[:, :, None] != rows_b[:, None, :]
        t, i, j = np.nonzero(close)
        k, head, tail = self.m[tiles][t] // 3, head[t, i, j], tail[t, i, j]
        first = np.where(head >= 2 * k, 0, np.where((head >= k) & (tail >= k), 1, 2))
        own = first == side[t, 0, 0]
        x, y = rows_a[t, i][own], rows_b[t, j][own]
        two = ~self.one[tiles][t][own]  # two blocks of a large tile: the pair counts for both of its rows
        return [(x, y), (y[two], x[two])]

    def _block(self, start: np.ndarray, size: np.ndarray, g: int):
        """Row numbers (-1: none) and the padded code points from the start and from the end."""
        rows = np.where(np.arange(g) < size[:, None], start[:, None] + np.arange(g), -1)
        held = [self.words[r] if r >= 0 else b"" for r in rows.ravel().tolist()]
        width = max(map(len, held))
        points = lambda w: np.array(w, f"S{width}").view(np.uint8).reshape(*rows.shape, width)
        return rows, (points(held), points([w[::-1] for w in held]))

    def told(self) -> pa.RecordBatch | None:
        """Per row with near words: how many, and the best of them."""
        row, other = self.links()
        if not len(row):
            return None
        order = np.lexsort((other, -self.n[other], row))  # within a block, rows are in the order of their words
        row, other = row[order], other[order]
        at = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        near = np.diff(np.append(at, len(row)))
        text = lambda rows: pa.array([self.words[r].decode("latin-1") for r in rows.tolist()], pa.string())
        return pa.RecordBatch.from_arrays([text(row[at]), pa.array(near), pa.array(self.n[other[at]]), text(other[at])], names=["word", "n_near", "best_n", "best"])


def _whole_tiles(batches) -> Iterator[pa.Table]:
    """Batches cut at borders of tiles; a tile, two blocks at most, goes on in the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        last = np.ones(table.num_rows, bool)
        for c in TILE:
            values = table.column(c).to_numpy()
            last &= values == values[-1] if len(values) else last
        cut = table.num_rows - int(last[::-1].cumprod().sum())
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held


def near_words(counted: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best`` of every word with near words (exactly one edit apart)."""

    def compare(batches):
        for table in _whole_tiles(batches):
            if (found := Tiles(table).told()) is not None:
                yield found

    found = tiled(counted, block).mapInArrow(compare, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best")


def rooted(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: each round doubles the steps taken; counts grow along them, so they end."""
    now = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stage(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        unstage(now)
        now = after
        if not now.agg(F.max("moved")).first()[0]:
            return now.select("word", "root")
        moved, now = now, stage(now.select("word", "root"), "spelling-roots")
        unstage(moved)


def variants(docs: DataFrame, ratio: int = RATIO, block: int = BLOCK, every: int = DAMAGE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    counted = stage(words(docs, every=every), "spelling-words")
    formed = counted.join(near_words(counted, block), "word", "left")
    better = F.col("best_n") >= ratio * F.col("n")
    formed = stage(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(better, F.col("best")).alias("form"), F.when(better, F.col("best_n")).alias("form_n")), "spelling-forms")
    unstage(counted)
    roots = rooted(formed.filter("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
