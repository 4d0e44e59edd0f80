"""Token counts by two tiers of pre-token lengths: a broadcast table of the frequent ones, worker caches for the rest.

Counts of the vocabulary's tokens in whole texts.  A text is cut at white space and into the tokenizer's own
pre-tokens where these are certain (ASCII and Latin letters, digits, ASCII marks); a word with any other character
or with the opening of a special string stays whole.  Nothing spans such a cut, so a text has the sum of its
pre-tokens' tokens.  Tier one is a compact table of frequent pre-tokens and their lengths, found by bounded
summaries (Misra-Gries) of a sample of rows and broadcast as two byte strings.  Tier two is a byte-bounded cache of
each worker; its misses in a slice are encoded in one call.  No pre-token is shuffled, and the table only saves
work: whichever sample it comes from, counts are the tokenizer's own.

Defined results: null and empty texts have 0 bytes and 0 tokens; rows that repeat are counted each; null ids stay;
special strings are the tokenizer's special tokens, as by its default; a text of any length is read in pieces of a
few MB; columns other than ``doc_id`` and ``text`` are ignored; no rows, no rows.
"""

from __future__ import annotations

import heapq
import os
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import LATIN, MARKS, Recent, chunks, slices
from feedloom.llm.packing import tokenizer_path

TOKENIZER, LIMIT = "word_bpe_49k.json", 2048
#: Rows (about) whose pre-tokens are summarised for tier one, tasks that do so, and entries of a summary and the table.
SAMPLE, TASKS, FREQUENT = 4000, 8, 1 << 16

SPACE = re.compile(r"[\x20\t-\r]")
#: Fixed: the tokenizer's split of lower-cased text, spelled out for the characters it is certain of.
CERTAIN = rf"'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])|[{LATIN}]+|[0-9]|[{MARKS}]+"
PARTS = re.compile(CERTAIN)
#: A word with another character or a special string's opening, else the parts of words.
MIXED = re.compile(rf"(?:(?!<\|)[{LATIN}0-9{MARKS}])*(?:<\||[^{LATIN}0-9{MARKS}\x20\t-\r])[^\x20\t-\r]*|{CERTAIN}")
UNCERTAIN = re.compile(rf"<\||[^{LATIN}0-9{MARKS}\x20\t-\r]")


def pre_tokens(text: str) -> list[str]:
    """Pieces whose token counts add up to the text's."""
    return (MIXED if UNCERTAIN.search(text) else PARTS).findall(text)


class Counts:
    """Token counts of pre-tokens, by the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.cache = Recent()

    def encode(self, parts: list[str]) -> list[int]:
        """Counts of distinct pre-tokens; the certain ones in one call, each closed by a token of a word's end."""
        plain = [p for p in parts if not UNCERTAIN.search(p)]
        found = {}
        for i in range(0, len(plain), 10_000):
            held = plain[i : i + 10_000]
            ids = self.tokenizer.encode_batch_fast(["\n".join(held)], add_special_tokens=False)[0].ids
            found.update(zip(held, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1).tolist(), strict=True))
        mixed = [p for p in parts if p not in found]
        found.update(zip(mixed, (len(e.ids) for e in self.tokenizer.encode_batch_fast(mixed, add_special_tokens=False)), strict=True))
        return [found[p] for p in parts]

    def __call__(self, parts, frequent: dict) -> dict:
        known = {p: frequent[p] for p in parts if p in frequent}
        return known | self.cache.values_of((p for p in parts if p not in known), self.encode)


@lru_cache(maxsize=2)
def counts(path: str) -> Counts:
    return Counts(path)


def _pieces(text: str | None):
    return chunks(text, SPACE) if text else ()


def summary(batches, keep: int):
    """At most ``keep`` frequent pre-tokens of a task with their counts (Misra-Gries, cut back when twice as many)."""
    seen = Counter()
    for part in slices(batches):
        for text in part.column("text").to_pylist():
            for piece in _pieces(text):
                seen.update(p for p in pre_tokens(piece) if len(p) <= 64)
                if len(seen) > 2 * keep:
                    least = heapq.nlargest(keep + 1, seen.values())[-1]
                    seen = Counter({p: n - least for p, n in seen.items() if n > least})
    return seen.most_common(keep)


def frequent_lengths(docs: DataFrame, path: str, sample: int = SAMPLE, keep: int = FREQUENT) -> tuple[bytes, bytes]:
    """The table of tier one: its pre-tokens, each ended by a line feed, and their token counts (one byte each)."""

    def summarise(batches):
        found = summary(batches, keep)
        lengths = counts(path).encode([p for p, _ in found])
        rows = [(p, n, k) for (p, n), k in zip(found, lengths, strict=True) if k < 256]
        told = ["".join(p + "\n" for p, _, _ in rows).encode(), np.array([n for _, n, _ in rows], "<i8").tobytes(), bytes(k for _, _, k in rows)]
        yield pa.RecordBatch.from_arrays([pa.array([t], pa.binary()) for t in told], names=["parts", "seen", "tokens"])

    rows = docs.count()
    drawn = docs.select("text").sample(min(1.0, sample / max(rows, 1)), seed=12).repartition(TASKS)
    total, tokens = Counter(), {}
    for row in drawn.mapInArrow(summarise, "parts binary, seen binary, tokens binary").collect():  # one row a task
        parts = bytes(row["parts"]).decode().split("\n")[:-1]
        tokens.update(zip(parts, row["tokens"], strict=True))
        for p, n in zip(parts, np.frombuffer(row["seen"], "<i8").tolist(), strict=True):
            total[p] += n
    chosen = [p for p, _ in total.most_common(keep)]
    return "".join(p + "\n" for p in chosen).encode(), bytes(tokens[p] for p in chosen)


@lru_cache(maxsize=2)
def _opened(parts: bytes, lengths: bytes) -> dict[str, int]:
    return dict(zip(parts.decode().split("\n")[:-1], lengths, strict=True))


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text."""
    path = path or tokenizer_path(TOKENIZER)
    sent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, sample))

    def count(batches):
        frequent, encode = _opened(*sent.value), counts(path)
        for part in slices(batches, limit=2 << 20):
            texts = part.column("text")
            split = [(i, pre_tokens(t)) for i, t in enumerate(texts.to_pylist()) if t and len(t) <= 1 << 20]
            known = encode(set().union(*(p for _, p in split)), frequent)
            total = np.zeros(len(texts), np.int64)
            for i, parts in split:
                total[i] = sum(map(known.__getitem__, parts))
            for i, t in enumerate(texts.to_pylist()):
                if t and len(t) > 1 << 20:
                    for piece in _pieces(t):
                        parts = pre_tokens(piece)
                        known = encode(set(parts), frequent)
                        total[i] += sum(map(known.__getitem__, parts))
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), size, pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
