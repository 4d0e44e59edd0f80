"""Hand-written messages."""

import base64
import json

from feedloom.sources.messages import MESSAGE_SCHEMA


def encoded(value) -> str:
    text = value if isinstance(value, str) else json.dumps(value)
    return base64.b64encode(text.encode()).decode()


def envelope(collection, document, operation="insert"):
    return {"operation": operation, "collection": collection, "document": document, "timestamp": "2024-01-01T00:00:00Z"}


def messages(spark, payloads):
    rows = [
        {"message": {"data": encoded(p), "attributes": {}, "messageId": f"m{i}"}} for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def table(spark, collection, *documents):
    """Rows of a collection's table for hand-written documents, in order."""
    from feedloom.plans.ingest import collection_table

    df = collection_table(messages(spark, [envelope(collection, d) for d in documents]), collection)
    rows = {r["_message_id"]: r.asDict() for r in df.collect()}
    return [rows[f"m{i}"] for i in range(len(documents))]
