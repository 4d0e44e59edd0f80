"""Groups of rows that are compared with each other, in blocks: no group is larger in a task than two blocks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 2048


def blocked(rows: DataFrame, keys: list[str], size: str, identity: str, block: int = BLOCK) -> DataFrame:
    """Deals groups to tasks.  A group of more than ``block`` rows is hashed into blocks, and each pair of blocks
    becomes a group (lo, hi) of its own; ``own`` names a row's block."""
    count = F.ceil(F.col(size) / block).cast("int")
    own = F.when(count <= 1, 0).otherwise(F.pmod(F.xxhash64(identity), count)).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))))
    dealt = dealt.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other")
    keyed = [*keys, "lo", "hi"]
    return dealt.repartition(*keyed).sortWithinPartitions(*keyed)


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys, over batch borders; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        if held and last != tuple(c[0] for c in columns):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts, cuts[1:]):
            if held and a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)
