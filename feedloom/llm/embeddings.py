"""Near-duplicate vectors: Euclidean p-stable hashing of normalised vectors, then exact cosines.

For unit vectors ``|x - y|^2 = 2 - 2 cos``, so the threshold is a distance, and Gaussian projections quantised to
``STEP`` distances collide with a known probability at it.  A table's bucket is ``k`` such numbers; ``k`` grows with the
logarithm of the rows until vectors at right angles hardly meet, and the number of tables then follows so that a pair on
the threshold is missed with probability ``MISS`` at most.  Buckets of one vector are dropped before vectors are sent.

Within a bucket vectors are compared by blocks in the task.  A pair counts in the first table in which it meets, so
link counts are sums and no pair is written; for components each block returns only a forest of its links.

Equal vectors are one node with a count.  Defined results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different lengths never link; rows that repeat an id count as other vectors;
a null id is never smallest.  No rows, no result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.blocks import blocked, groups
from feedloom.llm.common import stage
from feedloom.llm.components import components

COSINE, STEP, MISS, SEED = 0.95, 6.0, 0.005, 11


def collision(ratio: float) -> float:
    """Chance that one quantised projection agrees, for a step of ``ratio`` times the distance."""
    tail = 0.5 * math.erfc(ratio / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-(ratio**2) / 2))


def parameters(rows: int, cosine: float = COSINE, step: float = STEP, miss: float = MISS) -> tuple[int, int, float]:
    """Projections per table, tables, and the step's width."""
    distance = math.sqrt(2 - 2 * cosine)
    near, far = collision(step), collision(step * distance / math.sqrt(2))
    k = max(4, math.ceil(math.log(max(rows, 2) * 16) / -math.log(far)))
    return k, math.ceil(math.log(miss) / math.log(1 - near**k)), step * distance


def _nodes(batches):
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            value = batch.column("embedding")[i].as_py()
            v = np.array([], np.float64) if not value or any(x is None for x in value) else np.array(value, np.float64) + 0.0
            sound = len(v) and np.isfinite(v).all() and v.any()
            out.append(xxhash.xxh3_128_digest(v.tobytes()) if sound else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(out, pa.binary())], names=["vec_id", "embedding", "node"])


def unit(rows: np.ndarray) -> np.ndarray:
    """Double-precision unit vectors; scaled by the largest component first, so that no square overflows."""
    scaled = rows / np.abs(rows).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _signatures(k: int, tables: int, width: float):
    """Adds the bucket number of each table to vectors of any length."""
    sizes: dict = {}

    def apply(batches):
        for batch in batches:
            found = batch.column("embedding").to_pylist()
            signs = [None] * len(found)
            for dim in {len(v) for v in found}:
                if dim not in sizes:
                    random = np.random.default_rng([SEED, dim])
                    sizes.clear()
                    sizes[dim] = random.standard_normal((dim, k * tables)), random.uniform(0, width, k * tables), random.integers(1, 1 << 62, k * tables, dtype=np.int64) * 2 + 1
                at, (lines, shift, mix) = [i for i, v in enumerate(found) if len(v) == dim], sizes[dim]
                for part in range(0, len(at), 512):
                    own = at[part : part + 512]
                    steps = np.floor((unit(np.array([found[i] for i in own], np.float64)) @ lines + shift) / width).astype(np.int64)
                    bucket = (steps * mix).reshape(len(own), tables, k).sum(2) ^ dim
                    for i, s in zip(own, bucket, strict=True):
                        signs[i] = s
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("embedding"), batch.column("copies"), pa.array(signs, pa.list_(pa.int64()))], names=["node", "embedding", "copies", "buckets"])

    return apply


def _links(table: pa.Table, cosine: float):
    """Per row of a block group: linked vectors first met here, and the node of its component within the group."""
    t = table.column("tbl")[0].as_py()
    v = unit(np.array(table.column("embedding").to_pylist(), np.float64))
    buckets = np.array(table.column("buckets").to_pylist(), np.int64)
    copies, block = table.column("copies").to_numpy(), table.column("own").to_numpy()
    cross = table.column("lo")[0].as_py() != table.column("hi")[0].as_py()
    count, root = np.zeros(len(v), np.int64), np.arange(len(v))
    for start in range(0, len(v), 256):
        near = v[start : start + 256] @ v.T >= cosine
        rows = np.arange(start, min(start + 256, len(v)))
        near[rows - start, rows] = False
        if cross:
            near &= block[rows][:, None] != block[None, :]
        x, y = np.nonzero(near)
        x += start
        for a, b in zip(x.tolist(), y.tolist()):  # union by smallest position
            while root[a] != a:
                root[a] = a = root[root[a]]
            while root[b] != b:
                root[b] = b = root[root[b]]
            root[max(a, b)] = min(a, b)
        new = ~(buckets[x, :t] == buckets[y, :t]).any(1) if t else np.ones(len(x), bool)
        np.add.at(count, x[new], copies[y[new]])
    while (root != root[root]).any():
        root = root[root]
    return count, root


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector (columns vec_id, embedding)."""
    typed = vectors.select(F.col("vec_id").cast("long"), "embedding")
    kind = typed.schema["embedding"].dataType.simpleString()
    marked = stage(typed.mapInArrow(_nodes, f"vec_id long, embedding {kind}, node binary"), "nv-marked")
    nodes = marked.filter("node is not null").groupBy("node").agg(F.first("embedding").alias("embedding"), F.count("node").alias("copies"), F.min("vec_id").alias("vec_id"))
    nodes = stage(nodes, "nv-nodes")
    k, tables, width = parameters(nodes.count(), cosine)
    signed = stage(nodes.select("node", "embedding", "copies").mapInArrow(_signatures(k, tables, width), f"node binary, embedding {kind}, copies long, buckets array<long>"), "nv-signed")
    posts = signed.select("node", F.posexplode("buckets").alias("tbl", "bucket"))
    sizes = posts.groupBy("tbl", "bucket").agg(F.count("node").alias("size")).filter("size > 1")
    met = stage(posts.join(sizes, ["tbl", "bucket"]), "nv-met")
    dealt = blocked(met.join(signed, "node"), ["tbl", "bucket"], "size", "node")

    def compare(batches):
        for table in groups(batches, ["tbl", "bucket", "lo", "hi"]):
            count, root = _links(table, cosine)
            names = table.column("node").to_pylist()
            own = np.flatnonzero((count > 0) | (root != np.arange(len(root))))
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in own], pa.binary()), pa.array([names[root[i]] for i in own], pa.binary()), pa.array(count[own])], names=["a", "b", "n"])

    found = stage(dealt.mapInArrow(compare, "a binary, b binary, n long"), "nv-links")
    degree = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.select("a", "b"))
    least = nodes.select("node", "vec_id").join(roots, "node").groupBy("root").agg(F.min("vec_id").alias("least"))
    classes = nodes.join(degree, "node", "left").join(roots, "node", "left").join(least, "root", "left")
    classes = classes.select(F.col("node").alias("_node"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("least", "vec_id").alias("class"))
    sound = marked.filter("node is not null").join(classes, F.col("node") == F.col("_node")).select("vec_id", "links", "class")
    rest = marked.filter("node is null").select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("class"))
    out = sound.unionByName(rest)
    return out.select("vec_id", F.col("links").alias("n_links"), F.col("class").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("class")).alias("kept"))
