"""Mixing sources to target weights: hash-random keys, a sort within each source, distributed prefix sums, exact cuts.

A document's key is the md5 of its id.  Keys are uniform, so their leading bits cut each source into
ranges of even size; the sums of the ranges (one row per source and range, pre-aggregated before the
shuffle) give the offsets, and only the one range of each source in which its budget ends is sorted.
What remains is one row per source: how often it is repeated whole, and the key at which the last
repetition stops.  Documents then meet that small table, whose size Spark checks before it broadcasts.

Defined results: null text has size 0; a null source is a source of its own, last in order; a null id
has the empty key.  Rows that agree in id, size and source share the words at the cut evenly, rounded
down.  No rows give no rows.  Columns other than the named ones are neither read nor needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import stage, word_count

WEIGHTS, SHARE, REPEAT = (3, 1, 2), 1.5, 2


def _source_key() -> Column:
    """A non-null key, so that ranges and joins share one partitioning."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))


def _order() -> Column:
    return F.struct(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("hash"), F.col("doc_id").cast("long").alias("doc_id"), F.col("size"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """Target words of each source from ``(source_key, source, source_size)``, one row per source.

    Sources take ``share`` of all words by weight, none more than ``repeat`` times its size; what is
    above is shared again by weight.  That ends where every uncapped source has the same words per
    weight, the level, found by walking the sources in the order in which they fill up.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    cap = F.col("source_size") * repeat
    ranked = sizes.withColumn("rank", rank).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    filling, everything = W.orderBy(F.col("fills_at"), "rank"), W.partitionBy()
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    walked = ranked.withColumn("fills_at", cap.cast("double") / F.col("weight")).select(
        "*",
        (
            (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        ).alias("level"),
    )
    level = F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "rank", "level"))).over(everything)["level"]
    return walked.withColumn("level", level).select("source_key", "source_size", F.least(cap.cast("double"), F.col("weight") * F.col("level")).alias("target"))


def cuts(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """One row per source: size, target, whole repetitions, and the place at which the last one ends.

    ``sized`` is a stored table ``(doc_id, source, size)``.  ``cut`` is null where no part is left to take.
    """
    bits = max(4, min(30, (max(1, sized.count()).bit_length() + 1) // 2))  # about the square root of the rows
    keyed = sized.select(_source_key().alias("source_key"), "source", "size", _order().alias("place"))
    keyed = keyed.withColumn("range", F.shiftright(F.conv(F.substring("place.hash", 1, 8), 16, 10).cast("long"), 32 - bits))
    sums = keyed.groupBy("source_key", "range").agg(F.first("source").alias("source"), F.sum("size").alias("words"))
    sums = stage(sums, "mix-ranges")
    plan = targets(sums.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size")), weights, share, repeat)
    budget = F.floor("target").cast("long")
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
    plan = stage(plan.withColumn("rest", budget - F.col("epochs") * F.col("source_size")), "mix-plan")
    offset = F.coalesce(F.sum("words").over(W.partitionBy("source_key").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    last = sums.withColumn("offset", offset).join(plan.select("source_key", "rest"), "source_key")
    last = last.filter((F.col("offset") <= F.col("rest")) & (F.col("rest") < F.col("offset") + F.col("words")) & (F.col("rest") > 0))
    last = stage(last.select("source_key", "range", (F.col("rest") - F.col("offset")).alias("rest")), "mix-last")
    inside = keyed.join(last, ["source_key", "range"]).groupBy("source_key", "range", "rest", "place").agg(F.count("size").alias("copies"))
    block = F.col("place.size") * F.col("copies")
    start = F.coalesce(F.sum(block).over(W.partitionBy("source_key", "range").orderBy("place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ends = inside.withColumn("start", start).filter((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + block))
    ends = ends.select("source_key", F.col("place").alias("cut"), F.floor((F.col("rest") - F.col("start")) / F.col("copies")).cast("long").alias("part"))
    return stage(plan.join(ends, "source_key", "left"), "mix-cuts")


def _taken() -> Column:
    whole = F.when((F.col("rest") > 0) & (_order() < F.col("cut")), F.col("size")).when((F.col("rest") > 0) & (_order() == F.col("cut")), F.col("part"))
    return (F.col("epochs") * F.col("size") + F.coalesce(whole, F.lit(0))).cast("long")


def mixture(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target of its source, and the words that the mix takes of it."""
    sized = stage(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    marked = sized.withColumn("source_key", _source_key()).join(cuts(sized, weights, share, repeat), "source_key")
    return marked.select("doc_id", "size", "source_size", "target", _taken().alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as taken; the one cut document of a source keeps its first words.

    ``n_chars``, where there is one, follows the text.
    """
    sized = stage(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    plan = cuts(sized, weights, share, repeat).withColumnRenamed("source_key", "_key")
    kept = docs.columns
    marked = docs.select(F.struct(*[F.col(c) for c in kept]).alias("row"), "doc_id", "source", word_count().alias("size"))
    marked = marked.join(plan, F.col("_key") == _source_key()).select("row", "size", _taken().alias("taken"))
    copies = F.when(F.col("taken") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rows = marked.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies))))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    text = F.when(left >= F.col("size"), F.col("row.text")).otherwise(_first_words(F.col("row.text"), left))
    out = rows.select("row", text.alias("_text"))
    fields = [F.col("_text").alias(c) if c == "text" else F.coalesce(F.length("_text"), F.lit(0)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in kept]
    return out.select(*fields)


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    parts = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    led = F.slice(parts, F.lit(1), n.cast("int"))
    return F.array_join(led, "")
