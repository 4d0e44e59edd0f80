"""Quality rules on repetition: suffix arrays over words, LCP intervals, covered fraction and longest repeat.

Each text has a suffix array of its words, built by prefix doubling: ranks of 1, 2, 4 ... words until all are
distinct, so ordinary texts need few rounds.  The longest common prefix of neighbours comes from the same ranks,
longest power first.  The words from position i that occur again begin at i or elsewhere are the larger of the
two LCPs beside it in the array: the depth of the smallest LCP interval around it, a maximal repeated substring.
Spans of at least ``SPAN`` words are united; a text fails if they cover more than ``COVER`` of it, or if the longest
repeat alone is more than ``LONGEST`` words, whatever share of the text that is.  Both reach below the base rule, which
counts repeated windows of three words and wants more than half of them; a line or two that come again in a short
text stay below both.  All of it is per text and of n log n cost; a text of any length is judged whole.

Defined results: null and empty texts have no words, zero counts and fail the base rule; repeated rows are judged
each; extra columns are ignored; no rows, no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import slices, words

MIN_WORDS, WINDOW, MOST_REPEATED = 50, 3, 50
SPAN, COVER, LONGEST = 8, 0.35, 50
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, covered_words long, longest_repeat long"


def suffix_ranks(tokens: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and the ranks by 1, 2, 4 ... tokens; an end of text differs from every token."""
    n = len(tokens)
    rank = np.append(np.unique(tokens, return_inverse=True)[1] + 1, 0)
    levels, width = [rank], 1
    order = np.argsort(rank[:-1], kind="stable")
    while True:
        sorted_ = rank[order]
        if n < 2 or (sorted_[1:] != sorted_[:-1]).all():
            return order, levels
        after = np.minimum(np.arange(n) + width, n)
        key = rank[:-1].astype(np.int64) * (n + 2) + rank[after]
        order = np.argsort(key, kind="stable")
        steps = np.concatenate(([1], (key[order][1:] != key[order][:-1]).astype(np.int64)))
        rank = np.zeros(n + 1, np.int64)
        rank[order] = np.cumsum(steps)
        levels.append(rank)
        width *= 2


def repeat_lengths(tokens: np.ndarray) -> np.ndarray:
    """Per position, how many tokens from there on occur once more in the text."""
    n = len(tokens)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    order, levels = suffix_ranks(tokens)
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = (levels[k][a] == levels[k][b]) & (levels[k][a] > 0)
        step = np.where(same, 1 << k, 0)
        common += step
        a, b = np.minimum(a + step, n), np.minimum(b + step, n)
    out[order[:-1]] = common
    out[order[1:]] = np.maximum(out[order[1:]], common)
    return out


def covered(lengths: np.ndarray, least: int, span: np.ndarray | int) -> int:
    """Positions in the union of spans that begin where at least ``least`` tokens repeat."""
    begin = np.flatnonzero(lengths >= least)
    if not len(begin):
        return 0
    edge = np.zeros(len(lengths) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + (span[begin] if isinstance(span, np.ndarray) else span), -1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1] > 0))


def measure(text: str | None) -> tuple:
    text = text or ""
    found = words(text)
    numbers: dict[bytes, int] = {}
    tokens = np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found))
    lengths = repeat_lengths(tokens)
    lines = [line for line in text.split("\n") if line.strip(SPACES)] if found else []
    n, repeated, longest = len(found), covered(lengths, WINDOW, WINDOW), int(lengths.max(initial=0))
    spans = covered(lengths, SPAN, lengths)
    failed = n < MIN_WORDS or 100 * repeated > MOST_REPEATED * n
    kept = not failed and spans <= COVER * n and longest <= LONGEST
    chars = len(text) - sum(map(text.count, SPACES))
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, failed, kept, spans, longest


def judge(docs: DataFrame) -> DataFrame:
    """The measures and verdicts of every document."""
    kinds = (pa.int64(),) * 5 + (pa.bool_(),) * 2 + (pa.int64(),) * 2
    names = [c.split()[0] for c in RESULT.split(", ")]

    def apply(batches):
        for part in slices(batches):
            rows = zip(*map(measure, part.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, t) for c, t in zip(rows, kinds, strict=True))], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(apply, RESULT)
