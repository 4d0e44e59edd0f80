"""Conforming a table to a target schema, with drift and quality warnings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the five target types in warning text.
TYPE_LABELS = {
    "string": "string",
    "bigint": "int64",
    "double": "double",
    "boolean": "bool",
    "timestamp": "timestamp[ns]",
}
NULL_SHARE_LIMIT = 50.0


@dataclass(frozen=True)
class ColumnPlan:
    """How a table's columns line up with a target schema (decided at plan time)."""

    missing: tuple[T.StructField, ...]
    extra: tuple[str, ...]


def line_up(columns: list[str], schema: T.StructType) -> ColumnPlan:
    have = set(columns)
    wanted = {f.name for f in schema.fields}
    return ColumnPlan(
        tuple(f for f in schema.fields if f.name not in have),
        tuple(sorted(have - wanted)),
    )


def lenient_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Best-effort conversion: NULL where a value has no form in the target type.

    Text is read into numbers and times, numbers are cut to whole numbers, anything becomes
    text, and text becomes a boolean by not being empty.
    """
    if source == target:
        return column
    if isinstance(target, T.StringType):
        nested = isinstance(source, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
        return F.to_json(column) if nested else column.cast("string")
    if isinstance(target, T.BooleanType) and isinstance(source, T.StringType):
        return F.when(column.isNotNull(), column != "")
    if isinstance(target, T.LongType) and isinstance(source, T.StringType):
        return F.coalesce(column.try_cast("bigint"), column.try_cast("double").try_cast("bigint"))
    return column.try_cast(target)


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Target columns in target order: absent ones as typed NULL, extra ones gone, others cast."""
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = [
        lenient_cast(F.col(f.name), have[f.name], f.dataType).alias(f.name)
        if f.name in have
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*columns, *keep)


def severity_of(message: Column) -> Column:
    return (
        F.when(message.contains("CRITICAL"), "ERROR")
        .when(message.contains("DATA_QUALITY"), "INFO")
        .otherwise("WARNING")
    )


def _label(data_type: T.DataType) -> str:
    return TYPE_LABELS.get(data_type.simpleString(), data_type.simpleString())


# The texts of all warnings below.
def structural_warnings(columns: list[str], schema: T.StructType) -> list[str]:
    """Warnings known from column names alone, without running a job."""
    plan = line_up(columns, schema)
    found = [
        f"SCHEMA_DRIFT: Added missing field '{f.name}' ({_label(f.dataType)}) with None"
        for f in plan.missing
    ]
    if plan.extra:
        names = ", ".join(f"'{name}'" for name in plan.extra)
        found.append("SCHEMA_DRIFT: Dropping unexpected fields: {" + names + "}")
    return found


def column_measures(df: DataFrame, schema: T.StructType, by: tuple[str, ...] = (), losses: str | None = None) -> DataFrame:
    """One row per (group and) target column: rows, nulls, values lost by the cast.

    A single aggregation pass over all columns; every task sends one partial row per group.  ``losses``
    names a column that lists each row's lost targets, where the casts were made before.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    per_column = []
    for f in schema.fields:
        if f.name in have:
            source = F.col(f.name)
            cast = lenient_cast(source, have[f.name], f.dataType)
            nulls = F.count_if(cast.isNull())
            # Few rows have lost anything, so most are not searched for every field.
            listed = (F.size(losses) > 0) & F.array_contains(losses, f.name) if losses else None
            lost = F.count_if(listed if losses else source.isNotNull() & cast.isNull())
        else:
            nulls, lost = F.count(F.lit(1)), F.lit(0).cast("bigint")
        per_column.append(
            F.struct(F.lit(f.name).alias("field"), nulls.alias("nulls"), lost.alias("lost"))
        )
    grouped = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.array(*per_column).alias("columns")
    )
    return grouped.select(*by, "rows", F.explode("columns").alias("c")).select(
        *by, "rows", "c.field", "c.nulls", "c.lost"
    )


def quality_warnings(measures: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Null-share and failed-cast warnings from ``column_measures``."""
    share = F.col("nulls") * 100.0 / F.col("rows")
    null_text = F.format_string(
        "DATA_QUALITY: Field '%s' has %.1f%% null values", F.col("field"), share
    )
    cast_text = F.format_string(
        "TYPE_MISMATCH: COLUMN_CAST_FAILED for '%s' in %d rows", F.col("field"), F.col("lost")
    )
    both = F.array(
        F.when((F.col("rows") > 0) & (share > NULL_SHARE_LIMIT), null_text),
        F.when(F.col("lost") > 0, cast_text),
    )
    return (
        measures.select(*by, "field", F.explode(both).alias("message"))
        .filter(F.col("message").isNotNull())
        .select(*by, "field", "message", severity_of(F.col("message")).alias("severity"))
    )


def drift_report(
    df: DataFrame,
    schema: T.StructType,
    collection: str,
    as_of: Column | None = None,
    columns: list[str] | None = None,
    losses: str | None = None,
) -> DataFrame:
    """Every warning for a table as rows (order, message, collection, severity, timestamp).

    A table without rows gives the single warning that it is empty.  For a table that was conformed before,
    ``columns`` are those it had then and ``losses`` is the column that lists each row's lost targets.
    """
    structural = structural_warnings(df.columns if columns is None else columns, schema)
    measured = column_measures(df, schema, losses=losses)
    fixed = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(m).alias("message")) for i, m in enumerate(structural)])
    if not structural:
        fixed = F.array().cast("array<struct<position:int,message:string>>")
    totals = measured.groupBy().agg(F.max("rows").alias("rows"))
    static = totals.select(
        F.explode(
            F.when(
                F.col("rows") > 0, fixed
            ).otherwise(
                F.array(F.struct(F.lit(0).alias("position"), F.lit("DataFrame is empty").alias("message")))
            )
        ).alias("w")
    ).select("w.position", "w.message")
    order = {f.name: i for i, f in enumerate(schema.fields)}
    position = F.create_map(*[x for n, i in order.items() for x in (F.lit(n), F.lit(len(structural) + i))])
    quality = (
        quality_warnings(measured.filter(F.col("rows") > 0))
        .select(F.try_element_at(position, F.col("field")).alias("position"), "message")
    )
    return static.unionByName(quality).select(
        "position",
        "message",
        F.lit(collection).alias("collection"),
        severity_of(F.col("message")).alias("severity"),
        (F.current_timestamp() if as_of is None else as_of).alias("timestamp"),
    )


def document_warnings(
    table: DataFrame, collection: str, losses: str, document: str, message: str, position: str, as_of: Column | None = None
) -> DataFrame:
    """The warnings about single documents: each value that could not be read, and what was saved without them.

    ``losses`` lists a row's lost targets; ``document``, ``message`` and ``position`` name its origin.
    """
    lost = F.col(losses)
    failed = F.transform(lost, lambda f: F.format_string("TYPE_MISMATCH: COLUMN_CAST_FAILED for '%s' in 1 rows", f))
    names = F.array_join(F.transform(lost, lambda f: F.concat(F.lit("'"), f, F.lit("'"))), ", ")
    saved = F.format_string("RECOVERY: Dropped columns due to errors: [%s]", names)
    told = table.filter(F.size(lost) > 0).select(
        F.col(document).alias("document_id"), F.col(message).alias("message_id"), F.col(position).alias("pos"),
        F.posexplode(F.concat(failed, F.array(saved))).alias("position", "message"),
    )
    return told.select(
        "position", "message", F.lit(collection).alias("collection"), severity_of(F.col("message")).alias("severity"),
        (F.current_timestamp() if as_of is None else as_of).alias("timestamp"), "document_id", "message_id", "pos",
    )


def drift_summary(report: DataFrame) -> DataFrame:
    """Warning count and the first three warnings of each collection.

    Warnings number at most a few per schema field, so a collection's list is bounded by its
    schema, not by the data.
    """
    first = F.slice(F.array_sort(F.collect_list(F.struct("position", "message"))), 1, 3)
    return report.groupBy("collection").agg(
        F.count(F.lit(1)).alias("schema_drift_count"),
        F.array_join(F.transform(first, lambda w: w["message"]), "; ").alias("schema_drift_summary"),
    )


def recover(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Saves what converts: a value that does not becomes NULL in its own row, the others stay.

    Returns the table and a one-row summary of the columns that lost values (recovery_mode,
    dropped_columns, original_column_count).
    """
    bad = [
        row["field"]
        for row in column_measures(df, schema).filter(F.col("lost") > 0).select("field").collect()
    ]
    order = [f.name for f in schema.fields if f.name in bad]
    table = conform(df, schema, keep)
    kept = len(schema.fields) - len(order)
    summary = df.sparkSession.range(1).select(
        F.lit(bool(order)).alias("recovery_mode"),
        F.lit(",".join(order)).alias("dropped_columns"),
        F.lit(len(schema.fields)).alias("original_column_count"),
        F.lit(f"PARTIAL SUCCESS: Saved {kept}/{len(schema.fields)} columns" if order else "").alias("message"),
    )
    return table, summary
