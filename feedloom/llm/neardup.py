"""Near-duplicate documents: an inverted join over signature coordinates, confirmed on full shingle sets.

Documents with one and the same shingle set are one node.  A node's signature has ``K`` MinHash coordinates, and
it is posted under each (coordinate, value).  Two nodes of similarity 0.75 share about 0.75 K coordinates; pairs
that share at least ``MATCH`` are kept (fewer happens to about one pair in 40,000 that lies just on the threshold).
Such pairs meet under one of the ``K - MATCH + 1`` rarest postings of either node: this prefix alone is joined, long
postings are skipped, and the remaining coordinates are probed in the signatures.

Dense groups are not paired out.  First every node meets two leaders of each posting; confirmed links are closed
to components.  Then nodes of one posting are compared only across components, in blocks inside the task, and
only links between full sets leave it.  Shingles that no other candidate has bound a node's similarity to any other
(at most ``(size - own) / (size + own')``), which settles most members of large groups without a comparison.

Defined results: null text or text without words has an empty set, size 0, links with nothing and is kept; fewer
words than five are one shingle; rows that repeat an id fall into that id's component; a null id is never smallest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.blocks import blocked, groups
from feedloom.llm.common import MIX, WORD, Memo, lower_words, slices, stage
from feedloom.llm.components import components

WIDTH, PERCENT, K, MATCH = 5, 75, 64, 34
_RANDOM = np.random.default_rng(20240229)
_FACTOR = _RANDOM.integers(1, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RANDOM.integers(0, 1 << 63, K, dtype=np.uint64)


def shingles(text: str | None, hashed, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    found = lower_words(text)
    h = np.fromiter(map(hashed, found), np.uint64, len(found))
    if not len(h):
        return h
    n = max(1, len(h) - width + 1)
    mixed = np.full(n, len(h) if len(h) < width else width, np.uint64)
    for j in range(min(width, len(h))):
        mixed = (mixed ^ h[j : j + n]) * MIX[j % len(MIX)]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(of: np.ndarray) -> np.ndarray:
    """The K coordinates, 32 bits each."""
    least = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(of), 2048):
        np.minimum(least, (of[i : i + 2048, None] * _FACTOR + _SHIFT).min(0), out=least)
    return (least ^ (least >> np.uint64(32))).astype(np.uint32).view(np.int32)


def _word_hash():
    return Memo(xxhash.xxh3_64_intdigest, 100_000).__getitem__


def sign(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, set size, node (digest of the set) and signature, beside the columns to keep; node and signature are null for an empty set."""

    def apply(batches):
        hashed = _word_hash()
        for part in slices(batches):
            sets = [shingles(t, hashed) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in keep),
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.list_(pa.int32())),
                ],
                names=[*keep, "doc_id", "n", "node", "signature"],
            )

    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, F.col("doc_id").cast("long"), "text").mapInArrow(apply, f"{kept}doc_id long, n long, node binary, signature array<int>")


def full_sets(docs: DataFrame) -> DataFrame:
    """node and its whole shingle set (hashes), one row per node."""

    def apply(batches):
        hashed = _word_hash()
        for part in slices(batches):
            sets = [s for s in (shingles(t, hashed) for t in part.column("text").to_pylist()) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "items"]
            )

    return docs.select("text").mapInArrow(apply, "node binary, items array<long>").dropDuplicates(["node"])


def prefix_postings(nodes: DataFrame) -> DataFrame:
    """(coordinate, value, node) within each node's prefix: its K - MATCH + 1 rarest postings, those of one node left out."""
    posts = nodes.select("node", F.posexplode("signature").alias("coordinate", "value"))
    shared = posts.groupBy("coordinate", "value").agg(F.count("node").alias("size")).filter("size > 1")
    met = posts.join(shared, ["coordinate", "value"])
    own = W.partitionBy("node")
    rank = F.row_number().over(own.orderBy("size", "coordinate"))
    marked = met.select("*", rank.alias("rank"), F.count("value").over(own).alias("common"))
    prefix = marked.filter(F.col("rank") <= F.lit(K - MATCH + 1) - (F.lit(K) - F.col("common"))).select("coordinate", "value", "node")
    prefix = stage(prefix, "nd-prefix")
    sizes = prefix.groupBy("coordinate", "value").agg(F.count("node").alias("size")).filter("size > 1")
    return stage(prefix.join(sizes, ["coordinate", "value"]), "nd-postings")


def _similar(common: Column, a: Column, b: Column, percent: int = PERCENT) -> Column:
    return common * 100 >= (a + b - common) * percent


def candidates(docs: DataFrame, nodes: DataFrame, posts: DataFrame) -> DataFrame:
    """Posted nodes that may still link: node, n, own (shingles no other posted node has), signature, prefix bits, items."""
    bits = posts.groupBy("node").agg(F.bit_or(F.expr("shiftleft(1L, coordinate)")).alias("prefix"))
    posted = nodes.join(bits, "node")
    chosen = posted.select(F.col("doc_id").alias("_first"))
    texts = docs.join(chosen, docs["doc_id"].cast("long").eqNullSafe(F.col("_first")), "left_semi")
    sets = stage(full_sets(texts).join(posted.select("node"), "node", "left_semi"), "nd-sets")
    single = sets.select("node", F.explode("items").alias("item")).groupBy("item").agg(F.count("node").alias("holders"), F.min("node").alias("node")).filter("holders = 1")
    own = single.groupBy("node").agg(F.count("item").alias("own"))
    full = posted.join(sets, "node").join(own, "node", "left").fillna(0, ["own"])
    full = full.filter(_similar(F.col("n") - F.col("own"), F.col("n"), F.col("n") - F.col("own")))
    return stage(full.select("node", "n", "own", "signature", "prefix", "items"), "nd-candidates")


def leader_links(posts: DataFrame, full: DataFrame) -> DataFrame:
    """Confirmed links of nodes with two leaders of each posting: the one with the smallest share of own shingles, and one by chance."""
    known = posts.join(full.select("node", (F.col("own") / F.col("n")).alias("odd")), "node")
    leaders = known.groupBy("coordinate", "value").agg(F.min(F.struct("odd", "node"))["node"].alias("first"), F.min(F.struct(F.xxhash64("node", "coordinate").alias("h"), "node"))["node"].alias("second"))
    met = known.join(leaders, ["coordinate", "value"]).select("node", F.explode(F.array("first", "second")).alias("leader")).filter("node <> leader")
    pairs = met.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    slim = full.select("node", "n", "own", "signature")
    left, right = (slim.select(*[F.col(c).alias(f"{c}_{side}") for c in slim.columns]) for side in "ab")
    near = pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
    matches = F.aggregate(F.zip_with("signature_a", "signature_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    most = F.least(F.col("n_a") - F.col("own_a"), F.col("n_b") - F.col("own_b"))
    near = stage(near.filter(_similar(most, F.col("n_a"), F.col("n_b"))).filter(matches >= MATCH).select("a", "b"), "nd-near")
    items = full.select("node", "items")
    both = near.join(items.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a").join(items.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b")
    linked = both.filter(_similar(F.size(F.array_intersect("items_a", "items_b")), F.size("items_a"), F.size("items_b")))
    return linked.select("a", "b")


def _across(table: pa.Table) -> list[tuple[bytes, bytes]]:
    """Links in one block group between nodes of different labels; the labels merge as links are found."""
    coordinate = table.column("coordinate")[0].as_py()
    n, own, block = (table.column(c).to_numpy() for c in ("n", "own", "own_block"))
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    prefix = table.column("prefix").to_numpy().view(np.uint64)
    names = table.column("node").to_pylist()
    numbers: dict = {}
    label = np.array([numbers.setdefault(x, len(numbers)) for x in table.column("label").to_pylist()])
    signed = np.vstack(table.column("signature").combine_chunks().flatten().to_numpy().reshape(len(n), K))
    items = table.column("items").combine_chunks()
    flat, ends = np.unique(items.flatten().to_numpy(), return_inverse=True)[1], items.offsets.to_numpy() - items.offsets.to_numpy()[0]
    mark, found = np.zeros(len(flat) and int(flat.max()) + 1, bool), []
    earlier = [j for j in range(coordinate)]
    for x in range(len(n) - 1):
        y = np.arange(x + 1, len(n))
        if lo != hi:
            y = y[block[y] != block[x]]
        y = y[label[y] != label[x]]
        most = np.minimum(n[x] - own[x], n[y] - own[y])
        y = y[100 * most >= PERCENT * (n[x] + n[y] - most)]
        if not len(y):
            continue
        same = signed[y] == signed[x]
        y, same = y[(keep := same.sum(1) >= MATCH)], same[keep]
        for j in earlier:  # a pair is compared at the first posting that both have in their prefix
            if len(y) and int(prefix[x]) >> j & 1:
                met = same[:, j] & ((prefix[y] >> np.uint64(j)) & np.uint64(1)).astype(bool)
                y, same = y[~met], same[~met]
        if not len(y):
            continue
        mark[flat[ends[x] : ends[x + 1]]] = True
        for k in y:
            if label[k] != label[x]:
                common = int(np.count_nonzero(mark[flat[ends[k] : ends[k + 1]]]))
                if 100 * common >= PERCENT * (n[x] + n[k] - common):
                    found.append((names[x], names[k]))
                    label[label == label[k]] = label[x]
        mark[flat[ends[x] : ends[x + 1]]] = False
    return found


def remaining_links(posts: DataFrame, full: DataFrame, labels: DataFrame) -> DataFrame:
    """Confirmed links across the components found so far, compared in blocks within each posting."""
    named = full.join(labels, full["node"] == labels["_node"], "left").withColumn("label", F.coalesce("root", "node")).drop("_node", "root")
    named = stage(named, "nd-named")
    met = posts.select("coordinate", "value", "node").join(named.select("node", "label"), "node")
    sizes = met.groupBy("coordinate", "value").agg(F.count("node").alias("size"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high and size > 2")
    open_ = stage(met.join(sizes.drop("low", "high"), ["coordinate", "value"]).select("coordinate", "value", "node", "size"), "nd-open")
    rows = open_.join(named, "node")
    # `own` of a block is set apart from the count of own shingles
    dealt = blocked(rows.withColumnRenamed("own", "_own"), ["coordinate", "value"], "size", "node").withColumnRenamed("own", "own_block").withColumnRenamed("_own", "own")

    def compare(batches):
        for table in groups(batches, ["coordinate", "value", "lo", "hi"]):
            if links := _across(table):
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.binary()), pa.array([x[1] for x in links], pa.binary())], names=["a", "b"])

    return dealt.mapInArrow(compare, "a binary, b binary")


def _grouped(docs: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signed rows, their nodes, and the root of every node that is linked."""
    signed = stage(sign(docs, *keep), "nd-signed")
    nodes = stage(signed.filter("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature")), "nd-nodes")
    posts = prefix_postings(nodes)
    full = candidates(docs, nodes, posts)
    links = stage(leader_links(posts, full), "nd-links")
    first = components(links).withColumnRenamed("node", "_node")
    more = stage(remaining_links(posts, full, first), "nd-more")
    return signed, nodes, components(links.union(more))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    signed, nodes, roots = _grouped(docs)
    least = nodes.select("node", "doc_id").join(roots, "node").groupBy("root").agg(F.min("doc_id").alias("least"))
    classes = nodes.select("node", "doc_id").join(roots, "node", "left").join(least, "root", "left")
    classes = classes.select(F.col("node").alias("_node"), F.coalesce("least", "doc_id").alias("class"))
    sound = signed.filter("node is not null").join(classes, F.col("node") == F.col("_node")).select("doc_id", "n", "class")
    placed = sound.unionByName(signed.filter("node is null").select("doc_id", "n", F.col("doc_id").alias("class")))
    return placed.select("doc_id", F.col("n").alias("n_shingles"), F.col("class").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("class")).alias("kept"))


def first_of_class(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` of which one per class of near-duplicates stays: that of the smallest id (nulls last) and digest.

    A row is known by its id and the digest of its text, so different texts of one id, or without one, are told
    apart; rows that repeat both stay once.  Texts without words are linked with nothing and all stay.
    """
    digest = F.md5(F.col("text").cast("binary"))
    signed, _, roots = _grouped(docs.select("doc_id", "text", digest.alias("_digest")), "_digest")
    rows = signed.filter("node is not null").select("doc_id", "_digest", "node").join(roots, "node", "left")
    rows = rows.groupBy(F.coalesce("root", "node").alias("class"), "doc_id", "_digest").agg(F.count("node").alias("times"))
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col("_digest").alias("digest"), "times")
    first = rows.groupBy("class").agg(F.min(place).alias("p")).select(*[F.col(f"p.{c}").alias(f"_nd_{c}") for c in ("id", "digest", "times")])
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    kept = docs.filter(worded).join(first, F.col("doc_id").cast("long").eqNullSafe(F.col("_nd_id")) & (digest == F.col("_nd_digest")))
    own = docs.columns
    many = kept.filter("_nd_times > 1").dropDuplicates(["_nd_id", "_nd_digest"])
    return kept.filter("_nd_times = 1").select(own).union(many.select(own)).union(docs.filter(~worded))
