"""Change event -> envelope -> publishable message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V

# The operations the feed keeps.
WHOLE_DOCUMENT_OPS = ("insert", "update", "replace")
KEPT_OPERATIONS = ("insert", "update", "delete", "replace")


def keep_operations(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("operationType").isin(*KEPT_OPERATIONS))


def document_by_operation() -> Column:
    """The whole document for writes, the key for deletes, otherwise nothing."""
    op = F.col("operationType")
    return F.when(op.isin(*WHOLE_DOCUMENT_OPS), F.col("fullDocument")).when(
        op == "delete", F.col("documentKey")
    )


def document_id() -> Column:
    key = V.text_of(V.get_keys("documentKey", "_id"))
    whole = V.text_of(V.get_keys("fullDocument", "_id"))
    return F.expr(f"coalesce({key}, {whole})")


def document_size() -> Column:
    """Length of the document's JSON, else of the key's JSON, else 0."""

    def length(name: str) -> str:
        return f"if({V.is_null(name)}, NULL, length(to_json({name})))"

    return F.expr(f"CAST(coalesce({length('fullDocument')}, {length('documentKey')}, 0) AS bigint)")


def to_envelope(
    changes: DataFrame, as_of: Column | None = None, correlation: str = "random"
) -> DataFrame:
    """The eight-field envelope of each change.

    ``correlation="token"`` derives the correlation id from the resume token, so a replay of
    the same change gives the same id; ``"random"`` draws a new one.
    """
    ids = {"random": F.uuid(), "token": F.sha2(F.col("_id"), 256)}
    return changes.select(
        F.col("operationType").alias("operation"),
        F.col("ns.coll").alias("collection"),
        F.col("ns.db").alias("database"),
        document_by_operation().alias("document"),
        (F.current_timestamp() if as_of is None else as_of).alias("timestamp"),
        F.col("clusterTime").cast("string").alias("oplog_timestamp"),
        ids[correlation].alias("correlation_id"),
        F.col("_id").alias("resume_token"),
    )


def envelope_json() -> Column:
    """An envelope row as JSON text; NULL members are written as JSON null."""
    return F.to_json(
        F.struct(
            "operation",
            "collection",
            "database",
            "document",
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
            "oplog_timestamp",
            "correlation_id",
            "resume_token",
        ),
        {"ignoreNullFields": "false"},
    )


def publishable(envelopes: DataFrame) -> DataFrame:
    """Key, value and headers of each envelope: the shape a message topic takes."""
    return envelopes.select(
        F.col("correlation_id").alias("key"),
        envelope_json().alias("value"),
        F.create_map(
            F.lit("operation"), F.col("operation"),
            F.lit("collection"), F.col("collection"),
            F.lit("database"), F.col("database"),
            F.lit("correlation_id"), F.col("correlation_id"),
        ).alias("headers"),
    )


def dead_letters(
    failed: DataFrame, topic: str, error: Column, attempts: int = 3, as_of: Column | None = None
) -> DataFrame:
    """Failed envelopes with the error context that goes to the dead-letter sink."""
    context = F.struct(
        F.lit(topic).alias("original_topic"),
        error.alias("error_message"),
        (F.current_timestamp() if as_of is None else as_of).alias("error_timestamp"),
        F.lit(attempts).alias("attempts"),
    )
    return failed.withColumn("_error_context", context)
