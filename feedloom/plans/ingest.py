"""Messages to collection tables: the composed batch plan (streaming reuses it per batch)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import variant as V
from ..operators.archive import write_collection_table, write_set_aside
from ..operators.conform import conform, document_warnings, drift_report
from ..operators.decode import decode, named_messages
from ..operators.dedup import first_per_key
from ..operators.ledger import derive_once, digest, read_committed, remove, unseen, write_parts
from ..operators.mapping import Collection, map_documents
from ..operators.routing import dispatch, processed, rejected, route, skipped
from .collections import DEFAULT_COLLECTION, REGISTRY

#: What a row brings along: its origin, and the targets whose values could not be read.
CARRIED = ("_operation", "_event_ts", "_message_id", "_pos", "_correlation_id", "_document_id", "_lost")
#: Collections written at the same time; their small jobs share the cores.
SIDE_BY_SIDE = 4
SECRET_COLUMNS = ("txt_password_hash", "cod_verification_token")


def route_messages(messages: DataFrame) -> DataFrame:
    return route(dispatch(decode(messages)), REGISTRY, DEFAULT_COLLECTION)


def transform_collection(
    routed: DataFrame,
    name: str,
    as_of: Column | None = None,
    redact: bool = False,
) -> DataFrame:
    """The conformed table of one collection from routed documents.

    ``redact`` replaces secrets (password hash, verification token) by their digest.
    """
    collection: Collection = REGISTRY[name]
    documents = processed(routed, name).select(
        "document",
        F.col("operation").alias("_operation"),
        F.col("event_ts").alias("_event_ts"),
        F.col("message_id").alias("_message_id"),
        F.col("pos").alias("_pos"),
        F.col("correlation_id").alias("_correlation_id"),
        F.expr(V.text_of(V.get_keys("document", "_id"))).alias("_document_id"),
    )
    mapped = map_documents(documents, collection, as_of=as_of, keep=CARRIED[:-1], losses="_lost")
    table = conform(mapped, collection.schema, keep=CARRIED)
    if redact:
        hidden = {c: F.sha2(F.col(c), 256) for c in SECRET_COLUMNS if c in table.columns}
        table = table.withColumns(hidden) if hidden else table
    return table


def drift_of(table: DataFrame, name: str, as_of: Column | None = None) -> DataFrame:
    """Warnings about rows of a collection's table: those of the batch (no document id), and those of documents."""
    collection: Collection = REGISTRY[name]
    batch = drift_report(table, collection.schema, name, as_of, collection.mapped_columns, "_lost")
    documents = document_warnings(table, name, "_lost", "_document_id", "_message_id", "_pos", as_of)
    return documents.unionByName(batch, allowMissingColumns=True)


def collection_table(messages: DataFrame, name: str, as_of: Column | None = None) -> DataFrame:
    return transform_collection(route_messages(messages), name, as_of)


def write_all_tables(
    messages: DataFrame,
    out: str,
    staging: str,
    as_of: Column | None = None,
    collections: Iterable[str] = tuple(REGISTRY),
) -> dict[str, str]:
    """Writes the table of every collection that occurs; returns name -> path.

    Every routed document ends in exactly one place, once per (message id, position): a collection's
    table, ``_skipped`` or ``_rejected`` (both below ``out``, by disposition and date).  The warnings about
    the rows that were new go to ``_drift`` (by collection), once, as they are read back from the table: no
    document is mapped a second time for them.  Collections are written side by side, a few at a time.

    Messages are decoded and routed once, into a Parquet table partitioned by collection in
    ``staging`` (a folder all executors share).  Each collection then reads its own partition
    only, so 22 collections cost two passes over the data rather than 22 decodings, and a lost
    executor redoes a read, not the decoding.  The staged rows hold each message id and position
    once; those that a table holds already are taken out before they are mapped.
    """
    spark = messages.sparkSession
    now = F.current_timestamp() if as_of is None else as_of
    staging = f"{staging}/{uuid.uuid4().hex}"  # of this run alone
    routed = route(dispatch(named_messages(decode(messages))), REGISTRY, DEFAULT_COLLECTION)
    write_parts(first_per_key(routed, ["message_id", "pos"], ["disposition"]), staging, "overwrite", "collection")
    routed = spark.read.schema(routed.schema).parquet(staging)
    present = {r["collection"] for r in processed(routed).select("collection").distinct().collect()}

    key = digest("message_id", "pos")

    def write(name: str) -> tuple[str, str]:
        path = f"{out}/{name}"
        with unseen(processed(routed, name), path, key) as fresh:
            if fresh is not None:
                write_collection_table(transform_collection(fresh, name, as_of), path, as_of, fresh=True)
        derive_once(spark, path, f"{out}/_drift/{name}", lambda rows: drift_of(rows, name, as_of), ["severity"])
        return name, path

    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        written = dict(pool.map(inheritable_thread_target(spark)(write), [n for n in collections if n in present]))
    for label, rows in (("_skipped", skipped(routed)), ("_rejected", rejected(routed))):
        with unseen(rows, f"{out}/{label}", key) as fresh:
            if fresh is not None:
                kept = fresh.withColumn("document", F.to_json("document")).withColumn("ingest_date", F.to_date(F.coalesce("event_ts", now)))
                write_set_aside(kept, f"{out}/{label}", fresh=True)
    remove(spark, staging)
    return written


def read_drift(spark: SparkSession, out: str, collections: Iterable[str]) -> DataFrame:
    """Warnings of the collections that ``write_all_tables`` wrote."""
    found = [read_committed(spark, f"{out}/_drift/{name}") for name in collections]
    return reduce(DataFrame.unionByName, found)
