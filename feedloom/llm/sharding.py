"""Sharding by extendible hashing: a directory indexed by hash bits, whose oversized buckets alone split on another bit.

Rows become ``(hash, bytes)``; sums by hash prefix are pre-aggregated before the shuffle, so neither a
text nor a whole bucket moves.  A batch of bits is tried at once: cells of the deepest prefix are added
up to every shorter one, and a cell's bucket is its shortest prefix that fits.  Only rows of cells that do
not fit yet go on to the next batch.  Rows of one and the same hash (copies of a key) that exceed the
limit together are told apart by a second hash over their row number, and split on by the same rule.

Defined results: null text has 0 bytes; a null key has the hash of the empty key; no rows give no shards;
a single row above the limit has a shard of its own (nothing can split it).  Extra columns are ignored.
Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stage

BITS, BATCH = 60, 12
SHARD_BYTES = 1 << 20


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the key's md5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _prefix(depth) -> Column:
    return F.expr(f"shiftright(h, {BITS} - {depth})")


def _cells(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Bucket depth of each ``high``-bit cell, null where no depth from ``low`` on fits."""
    fine = rows.groupBy(_prefix(high).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("h").alias("rows"), F.min("h").alias("least"), F.max("h").alias("most"))
    fine = stage(fine, "shard-cells")
    levels = fine.select("*", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("most").alias("most"))
    fits = (F.col("bytes") <= limit) | (F.col("least") == F.col("most"))
    ends = sums.filter(fits).select("depth", "prefix", F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows"))
    found = levels.select("cell", "depth", "prefix").join(ends, ["depth", "prefix"]).groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("shard"))
    return fine.select("cell").join(found, "cell", "left")


def _split(rows: DataFrame, limit: int, first: int) -> DataFrame:
    """``rows`` (id, h, bytes) with their bucket; rows of equal hash share one."""
    done, low, high, left = [], 0, min(BITS, first), rows
    while True:
        cells = stage(_cells(left, low, high, limit), "shard-directory")
        placed = left.withColumn("cell", _prefix(high)).join(cells, "cell").drop("cell")
        done.append(placed.filter("shard is not null"))
        if cells.filter("shard is null").isEmpty():
            break
        left = stage(placed.filter("shard is null").drop("shard"), "shard-rest")
        low, high = high + 1, min(BITS, high + BATCH)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _label(depth: Column, prefix: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, "0"))


def shards(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES, row: str | None = None) -> DataFrame:
    """Per row: the key, its bytes, and its shard (bits of the path, depth, bytes and rows it holds).

    Every shard holds at most ``limit`` bytes unless it is a single row.  ``row`` names a stored row number to return too.
    """
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    rows = stage(docs.select(F.col(key).alias("_key"), *([F.col(row).alias("_number")] if row else []), hash_bits(F.col(key)).alias("h"), size.alias("bytes")), "shard-rows")
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    split = _split(rows, limit, max(1, (total // limit + 1).bit_length() + 4))
    whole = (F.col("shard.shard_bytes") <= limit) | (F.col("shard.shard_rows") == 1)
    kept = ["_number"] if row else []
    columns = [F.col("_key").alias(key), "bytes"]
    fine = split.filter(whole).select(*columns, _label(F.col("shard.depth"), F.col("shard.prefix")).alias("shard"), F.col("shard.depth").alias("depth"), "shard.shard_bytes", "shard.shard_rows", *kept)
    equal = stage(split.filter(~whole).select("_key", "bytes", *kept, F.monotonically_increasing_id().alias("row"), _label(F.col("shard.depth"), F.col("shard.prefix")).alias("above"), F.col("h").alias("same")), "shard-equal")
    if equal.isEmpty():
        return fine.withColumnRenamed("_number", row) if row else fine
    inner = equal.withColumn("h", hash_bits(F.concat_ws("-", "same", "row")))
    pages = _split_equal(inner, limit, *kept)
    out = fine.unionByName(pages.withColumnRenamed("_key", key))
    return out.withColumnRenamed("_number", row) if row else out


def _split_equal(rows: DataFrame, limit: int, *keep: str) -> DataFrame:
    """Rows whose first hash says no more, split by the bits of a second one within each first hash."""
    depth = 0
    while True:
        depth = min(BITS, depth + BATCH)
        levels = F.explode(F.sequence(F.lit(0), F.lit(depth)))
        fine = stage(rows.groupBy("same", _prefix(depth).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("h").alias("rows")), "shard-cells")
        spread = fine.select("*", levels.alias("depth")).withColumn("prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
        ends = spread.groupBy("same", "depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows")).filter((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
        found = spread.select("same", "cell", "depth", "prefix").join(ends, ["same", "depth", "prefix"]).groupBy("same", "cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("shard"))
        cells = stage(fine.select("same", "cell").join(found, ["same", "cell"], "left"), "shard-directory")
        if depth == BITS or cells.filter("shard is null").isEmpty():
            break
    placed = rows.withColumn("cell", _prefix(depth)).join(cells, ["same", "cell"])
    path = F.concat("above", F.lit("+"), _label(F.col("shard.depth"), F.col("shard.prefix")))
    return placed.select("_key", "bytes", path.alias("shard"), (F.length("above") + F.col("shard.depth")).cast("int").alias("depth"), "shard.shard_bytes", "shard.shard_rows", *keep)


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """Writes the documents below ``path``, one folder ``shard=<bits>`` each, and returns the directory.

    Rows get a stored number first, so that copies of a key are told apart and each goes to the shard it was placed in.
    """
    numbered = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "shard-numbered")
    placed = stage(shards(numbered, key, text, limit, row="_row").select("_row", "shard"), "shard-places")
    out = numbered.join(placed, "_row").drop("_row")
    out.repartition("shard").sortWithinPartitions("shard").write.partitionBy("shard").parquet(path)
    return placed.groupBy("shard").agg(F.count("_row").alias("rows"))
