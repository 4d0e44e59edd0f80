"""Raw archive rows and idempotent sinks."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from . import ledger


def archive_rows(decoded: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One raw-archive row per message: untouched payload, its path and its metadata.

    The partition date is the publish date, so a message delivered again after midnight lands
    in the same place; the processing date is used where no publish time is known.
    """
    now = F.current_timestamp() if as_of is None else as_of
    text = lambda *keys: F.expr(V.get_keys("event", *keys, as_type="string"))
    ident = lambda holder: F.expr(V.text_of(V.get_keys("event", holder, "_id")))
    collection = F.coalesce(text("collection"), F.lit("unknown"))
    operation = F.coalesce(text("operation"), F.lit("unknown"))
    date = F.to_date(F.coalesce("publish_time", now))
    file_time = F.coalesce(
        F.substring(F.regexp_replace(text("timestamp"), "[:.]", "-"), 1, 19),
        F.date_format(now, "yyyyMMdd_HHmmss"),
    )
    name = F.coalesce(F.nullif("message_id", F.lit("")), F.md5("payload"))
    prefix = F.substring(name, 1, 8)
    # Fixed value: the form of an archived object's path.
    path = F.concat(
        F.lit("raw/"), collection, F.lit("/"), prefix, F.lit("-"),
        F.date_format(date, "yyyy-MM-dd"), F.lit("/"), operation, F.lit("_"),
        file_time, F.lit("_"), name, F.lit(".json"),
    )
    derived = F.struct(
        date.alias("ingest_date"),
        collection.alias("collection"),
        operation.alias("operation"),
        F.coalesce(ident("document"), ident("documentKey"), F.lit("unknown")).alias("document_id"),
        text("oplog_timestamp").alias("oplog_timestamp"),
        F.coalesce(
            text("correlation_id"),
            F.try_element_at("attributes", F.lit("correlation_id")),
            F.lit("unknown"),
        ).alias("correlation_id"),
        F.expr(V.get_keys("event", "resume_token")).isNotNull().alias("has_resume_token"),
        F.when(F.col("event").isNull(), "payload is not JSON").alias("parse_warning"),
        F.octet_length("payload").cast("bigint").alias("data_size_bytes"),
        now.alias("received_at"),
        prefix.alias("prefix"),
        path.alias("path"),
    )
    # Fenced like ``decode``: joins and filters on the path do not evaluate it twice.
    return decoded.filter("has_payload").select(
        "message_id", "publish_time", "payload", F.inline(F.array(derived))
    )


def write_archive(rows: DataFrame, path: str) -> int:
    """Adds each message to the archive once, however often, and whenever, it is delivered or the job is run.

    A message is known by its id alone, one without an id by the digest of its payload: neither the date, which
    may be the day of processing, nor the object path takes part.
    """
    content = F.sha2("payload", 256)
    key = ledger.digest(F.nullif("message_id", F.lit("")), F.when(F.coalesce("message_id", F.lit("")) == "", content))
    return ledger.add_once(rows, path, key, ["publish_time", "received_at", "path"], ["collection", "ingest_date"])


def write_objects(rows: DataFrame, root: str) -> int:
    """Writes each archive row's payload, byte for byte, as an object at its path below ``root``; returns how many.

    ``root`` is a folder that all executors share, or any URI that Arrow's file systems know.  An object appears
    whole under its name, so a task tried again, or a whole run, leaves the same objects.
    """

    def put(batches):
        from pyarrow import fs

        place, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        for batch in batches:
            for path, payload in zip(batch.column("path").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                name = f"{base}/{path}"
                place.create_dir(name.rpartition("/")[0], recursive=True)
                part = f"{name}.{uuid.uuid4().hex}"
                with place.open_output_stream(part) as out:
                    out.write(payload)
                place.move(part, name)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["objects"])

    return rows.select("path", "payload").mapInArrow(put, "objects bigint").agg(F.sum("objects")).first()[0] or 0


def write_collection_table(table: DataFrame, path: str, as_of: Column | None = None, fresh: bool = False) -> int:
    """Adds rows to the processed table of a collection, partitioned by operation and event date.

    A document counts once, by message id and position (without an id: by its whole row), whatever day or
    operation a copy of it names.  Earlier batches stay, and a batch written again adds nothing.  ``fresh`` as in
    ``ledger.add_once``.
    """
    now = F.current_timestamp() if as_of is None else as_of
    dated = table.withColumn("ingest_date", F.to_date(F.coalesce("_event_ts", now)))
    whole = F.sha2(F.to_json(F.struct(*table.columns)), 256)
    named = dated.withColumn("_message_id", F.coalesce(F.nullif("_message_id", F.lit("")), F.concat(F.lit("sha256:"), whole)))
    key, parts = ledger.digest("_message_id", "_pos"), ["_operation", "ingest_date"]
    return ledger.add_once(named, path, key, parts, parts, fresh)


def write_set_aside(rows: DataFrame, path: str, fresh: bool = False) -> int:
    """Adds skipped or rejected documents, each once by message id and position, by disposition and date."""
    key, parts = ledger.digest("message_id", "pos"), ["disposition", "ingest_date"]
    return ledger.add_once(rows, path, key, parts, parts, fresh)
