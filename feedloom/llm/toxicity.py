"""Toxic spans by a linear-chain conditional random field over tokens, with scores and offsets from its marginals.

Labels are per document, so tokens are labelled first: over a sample of labelled rows Spark counts in how many toxic
and clean texts each stem (a word, or its first three to six letters) occurs; stems that hardly occur in clean texts
are taken one by one, each for the toxic texts that none before it explains.  A token of a toxic text is labelled
toxic if it has such a stem.  The field has weights for words, stems, endings and transitions and is fitted by gradient
ascent of the token likelihood; a logistic curve over the marginals of a text's offending tokens, at the odds of the
labels in the sample, gives its score.

Forward and backward messages run over all tokens of a slice at once: the chain is cut into blocks, whose matrix
products are computed side by side, so whole texts are scored exactly, with resets where texts begin.

Learned from rows whose crc32(id) mod 4 is not 2; of these a sample of about ``SAMPLE`` rows counts stems and about
``FIT`` of them fit the field (documented bounds, chosen by a hash of the id).  A score reads the text alone.

Defined results: null text and text without letters have the score of a text without offending tokens; without labels of
both kinds every score is 0; a null id is not held out; rows and labels that repeat an id count once for each kind of
label, by their first text.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import Memo, drawn, slices, stage

SAMPLE, FIT, THRESHOLD, OFFENDING = 24_000, 1_200, 0.3, 0.5
ROUNDS, RIDGE, CHAIN = 40, 0.05, 64
TOKEN = re.compile(r"[^\W\d_]+")


class Field(NamedTuple):
    """Weights by feature, transitions (log), first-token weight, and the logistic curve over a text."""

    weights: dict[str, float]
    move: np.ndarray
    first: float
    curve: np.ndarray


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string")) % 4 == 2, F.lit(False))


def stems(word: str) -> list[str]:
    return [f"={word}", *(word[:n] for n in range(3, min(6, len(word)) + 1))]


def features(word: str) -> list[str]:
    return [*stems(word), f"~{word[-3:]}"]


def marginals(odds: np.ndarray, first: np.ndarray, move: np.ndarray, start: float):
    """Chance of state 1 at each token, and expected transition counts.

    ``odds`` are the tokens' log-odds; where ``first`` is set a text begins and nothing is passed on.
    """
    n = len(odds)
    if not n:
        return np.empty(0), np.zeros((2, 2))
    blocks = -(-n // CHAIN)
    pad = blocks * CHAIN - n
    psi = np.exp(np.clip(np.concatenate((odds, np.zeros(pad))), -30, 30))
    new = np.concatenate((first, np.ones(pad, bool)))
    a = np.exp(move)
    open_ = math.exp(start)
    m00, m10 = np.where(new, 1.0, a[0, 0]), np.where(new, 1.0, a[1, 0])
    m01, m11 = np.where(new, open_, a[0, 1]) * psi, np.where(new, open_, a[1, 1]) * psi
    m00, m01, m10, m11 = (x.reshape(blocks, CHAIN).T.copy() for x in (m00, m01, m10, m11))
    p00, p01, p10, p11 = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for t in range(CHAIN):
        p00, p01 = p00 * m00[t] + p01 * m10[t], p00 * m01[t] + p01 * m11[t]
        p10, p11 = p10 * m00[t] + p11 * m10[t], p10 * m01[t] + p11 * m11[t]
        scale = 1 / (p00 + p01 + p10 + p11)
        p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
    product = list(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist()))
    into, x, y = [], 0.5, 0.5
    for q00, q01, q10, q11 in product:
        into.append((x, y))
        x, y = x * q00 + y * q10, x * q01 + y * q11
        x, y = x / (x + y), y / (x + y)
    out, x, y = [], 0.5, 0.5
    for q00, q01, q10, q11 in reversed(product):
        out.append((x, y))
        x, y = q00 * x + q01 * y, q10 * x + q11 * y
        x, y = x / (x + y), y / (x + y)
    f0, f1 = np.array(into).T.copy()
    b0, b1 = np.array(out[::-1]).T.copy()
    before, after = np.empty((2, CHAIN, blocks)), np.empty((2, CHAIN, blocks))
    for t in range(CHAIN):
        before[0, t], before[1, t] = f0, f1
        f0, f1 = f0 * m00[t] + f1 * m10[t], f0 * m01[t] + f1 * m11[t]
        f0, f1 = f0 / (f0 + f1), f1 / (f0 + f1)
    for t in range(CHAIN - 1, -1, -1):
        after[0, t], after[1, t] = b0, b1
        b0, b1 = m00[t] * b0 + m01[t] * b1, m10[t] * b0 + m11[t] * b1
        b0, b1 = b0 / (b0 + b1), b1 / (b0 + b1)
    joint = np.stack([before[i] * m * after[j] for i, j, m in ((0, 0, m00), (0, 1, m01), (1, 0, m10), (1, 1, m11))]).reshape(4, CHAIN, blocks)
    joint = joint.transpose(0, 2, 1).reshape(4, -1)[:, :n]
    joint = joint / joint.sum(0)
    return joint[1] + joint[3], joint[:, ~first].sum(1).reshape(2, 2)


def places(text: str) -> list[tuple[int, int]]:
    """Where the tokens of the lower-cased text stand in the text itself, whose characters may be fewer."""
    lowered = text.lower()
    found = [m.span() for m in TOKEN.finditer(lowered)]
    if len(lowered) == len(text):
        return found
    ends = np.cumsum([len(c.lower()) for c in text])
    return [(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(ends, b - 1, "right")) + 1) for a, b in found]


def summary(chance: np.ndarray) -> tuple[float, float]:
    """What the curve sees of a text: expected offending tokens (log), and the strongest one."""
    hit = chance[chance > OFFENDING]
    return math.log1p(hit.sum()), float(chance.max(initial=0.0))


def labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, text and toxic of a sample of about ``sample`` training rows, written once.

    Rows that repeat an id and label count as one, so that copies of a labelled row do not enlarge the sample.
    """
    rows = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    share = min(1.0, sample / max(1, rows.count()))
    chosen = rows.filter(drawn("toxicity", share)).select(F.col("doc_id").alias("_id"), (F.col("toxic").cast("int") != 0).cast("int").alias("toxic"))
    found = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id"))  # broadcast where Spark measures it as small
    return stage(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic"), "toxicity-sample")


def _stem_counts(batches):
    for part in slices(batches, rows=4096):
        counts: dict[str, list[int]] = {}
        for text, toxic in {(t, x): None for t, x in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True)}:
            for s in {s for w in set(TOKEN.findall((text or "").lower())) for s in stems(w)}:
                counts.setdefault(s, [0, 0])[1 if toxic else 0] += 1
        rows = list(counts.items())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), pa.array([v[0] for _, v in rows], pa.int64()), pa.array([v[1] for _, v in rows], pa.int64())], names=["stem", "clean", "toxic"])


def _stems_of_rows(batches):
    for part in slices(batches, rows=4096):
        rows, found = [], []
        for row, text in zip(part.column("row").to_pylist(), part.column("text").to_pylist(), strict=True):
            own = {s for w in set(TOKEN.findall((text or "").lower())) for s in stems(w)}
            rows += [row] * len(own)
            found += own
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(found, pa.string())], names=["row", "stem"])


def offending_stems(sample: DataFrame) -> set[str]:
    """Stems of toxic texts that clean texts hardly have, chosen until no other explains three more toxic texts.

    The driver gets the numbers of the toxic sample rows that hold each candidate, and no text.
    """
    kinds = {bool(r["toxic"]): r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(kinds) < 2:
        return set()
    counts = sample.select("text", "toxic").mapInArrow(_stem_counts, "stem string, clean long, toxic long").groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = kinds[False] / max(1, kinds[True])
    rare = counts.filter((F.col("toxic") >= 3) & (F.col("clean") <= 0.02 * odds * F.col("toxic"))).select("stem", "clean")
    toxic = sample.filter("toxic = 1").select(F.xxhash64("text").alias("row"), "text").dropDuplicates(["row"])
    held = toxic.mapInArrow(_stems_of_rows, "row long, stem string").join(rare, "stem").groupBy("stem").agg(F.first("clean").alias("clean"), F.collect_set("row").alias("rows")).collect()
    clean = {r["stem"]: r["clean"] for r in held}
    holders = {r["stem"]: set(r["rows"]) for r in held}
    chosen: set[str] = set()
    while holders:
        best = max(holders, key=lambda s: (len(holders[s]) / (1 + clean[s]), -len(s), s))
        gain = holders.pop(best)
        if len(gain) < 3:
            break
        chosen.add(best)
        holders = {s: left for s, of in holders.items() if len(left := of - gain) >= 3}
    return chosen


def fit(rows: list[tuple[str, int]], offending: set[str], odds: float = 1.0) -> Field:
    """The field and the curve, from (text, toxic) rows; ``odds`` are those of toxic to clean texts where it is applied."""
    number: dict[str, int] = {}
    lists = [[number.setdefault(w, len(number)) for w in TOKEN.findall((t or "").lower())] for t, _ in rows]
    toxic = np.array([y for _, y in rows])
    bad = np.array([any(s in offending for s in stems(w)) for w in number], bool)
    token = np.concatenate([np.array(x, np.int64) for x in lists])
    length = np.array([len(x) for x in lists])
    text = np.repeat(np.arange(len(rows)), length)
    first = np.r_[True, text[1:] != text[:-1]] if len(text) else np.empty(0, bool)
    wanted = (bad[token] & (toxic[text] == 1)).astype(float)
    count: dict[str, int] = {}
    for w in number:
        for f in features(w):
            count[f] = count.get(f, 0) + 1
    often = np.bincount(token, minlength=len(number))
    count |= {f"={w}": int(often[i]) - 1 for w, i in number.items()}  # words seen three times at least
    names = {f: i for i, f in enumerate(f for f, c in count.items() if c > 1)}
    pairs = np.array([(i, names[f]) for w, i in number.items() for f in features(w) if f in names], np.int64).reshape(-1, 2)
    theta, bias, move, start = np.zeros(len(names)), -4.0, np.zeros((2, 2)), -4.0
    paired = ~first
    was, now = wanted[np.flatnonzero(paired) - 1], wanted[paired]
    seen = np.array([[np.sum((1 - was) * (1 - now)), np.sum((1 - was) * now)], [np.sum(was * (1 - now)), np.sum(was * now)]])
    speed, speed_b, speed_m = np.full(len(names), 1e-6), 1e-6, np.full((2, 2), 1e-6)
    for _ in range(ROUNDS):
        word = np.bincount(pairs[:, 0], theta[pairs[:, 1]], len(number)) + bias
        chance, moved = marginals(word[token], first, move, start)
        rest = np.bincount(token, wanted - chance, len(number))
        step = np.bincount(pairs[:, 1], rest[pairs[:, 0]], len(names)) - RIDGE * theta
        step_b, step_m = rest.sum(), seen - moved
        speed, speed_b, speed_m = speed + step**2, speed_b + step_b**2, speed_m + step_m**2
        theta, bias, move = theta + step / np.sqrt(speed), bias + 0.5 * step_b / math.sqrt(speed_b), move + 0.2 * step_m / np.sqrt(speed_m)
    chance, _ = marginals((np.bincount(pairs[:, 0], theta[pairs[:, 1]], len(number)) + bias)[token], first, move, start)
    bounds = np.r_[0, np.cumsum(length)]
    seen_ = np.array([(1.0, *summary(chance[a:b])) for a, b in zip(bounds[:-1], bounds[1:])])
    curve = np.zeros(3)
    weight = np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 / max(1, (toxic == 0).sum())) * len(toxic)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(seen_ @ curve, -30, 30)))
        slope = seen_.T @ (weight * (toxic - p)) - 0.02 * curve
        curve = curve + np.linalg.solve((seen_ * (weight * p * (1 - p))[:, None]).T @ seen_ + 0.02 * np.eye(3), slope)
    curve[0] += math.log(odds)  # the curve was fitted with both kinds weighing the same
    weights = {f: float(theta[i]) for f, i in names.items() if abs(theta[i]) > 0.01}
    return Field({**weights, "": bias}, move, start, curve)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = FIT) -> Field | None:
    """The field learned from a bounded sample; None without labels of both kinds."""
    rows = labelled(docs, labels, sample)
    offending = offending_stems(rows)
    if not offending:
        return None
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    fitted = []
    for kind in (0, 1):
        share = min(1.0, most / 2 / max(1, counts.get(kind, 0)))
        fitted += [(r["text"], kind) for r in rows.filter((F.col("toxic") == kind) & drawn("fit", share)).select("doc_id", "text").orderBy("doc_id", "text").limit(most).collect()]
    return fit(fitted, offending, counts[1] / counts[0])


def tag(docs: DataFrame, field: Field | None, *keep: str) -> DataFrame:
    """score, and spans (start, end: code points) of offending tokens, of every row, beside the columns to keep."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def apply(batches):
        model = sent.value
        if model:
            get, bias = model.weights.get, model.weights[""]
            odds = Memo(lambda w: bias + sum(get(f, 0.0) for f in features(w)), 150_000)
        for part in slices(batches, limit=1 << 20):
            texts = part.column("text").to_pylist()
            scores, spans = [0.0] * len(texts), [[] for _ in texts]
            if model:
                lists = [TOKEN.findall(t.lower()) if t else [] for t in texts]
                length = np.array([len(x) for x in lists])
                bounds = np.r_[0, np.cumsum(length)]
                first = np.zeros(bounds[-1], bool)
                first[bounds[:-1][length > 0]] = True
                chance, _ = marginals(np.fromiter((odds[w] for x in lists for w in x), float, bounds[-1]), first, model.move, model.first)
                for i, text in enumerate(texts):
                    own = chance[bounds[i] : bounds[i + 1]]
                    scores[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot((1.0, *summary(own)), model.curve))))))
                    hit = np.flatnonzero(own > OFFENDING)
                    if len(hit):
                        at = places(text)
                        spans[i] = [dict(zip(("start", "end"), at[j])) for j in hit]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(scores, pa.float64()), pa.array(spans, kind)], names=[*keep, "score", "spans"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(apply, f"{schema}, score double, spans array<struct<start:int,end:int>>")


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every document."""
    tagged = tag(docs, train(docs, labels, sample), "doc_id")
    return tagged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")
