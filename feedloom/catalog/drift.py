"""Warnings about single documents and batches, from messages whose values their fields cannot take."""

from __future__ import annotations

from dataclasses import dataclass

from ..plans.collections import REGISTRY
from ..plans.ingest import read_drift, write_all_tables
from ..session import prepare, table, work_dir
from ..streaming import pipelines as ST
from .samples import AS_OF, as_of


@dataclass(frozen=True)
class Slot:
    """A member of the sample's documents: portable SQL for its JSON text, its target and when that is lost."""

    text: str | None
    target: str
    lost: str = "false"


SLOTS = (
    Slot("""'"createdAt":' || CASE k % 7 WHEN 0 THEN '"soon"' WHEN 1 THEN '["","2024-01-02T00:00:00Z"]' ELSE '"2024-01-01T00:00:00Z"' END""", "ts_customer_created_at", "k % 7 = 0"),
    Slot("""'"updatedAt":' || CASE k % 9 WHEN 0 THEN '""' WHEN 1 THEN '{}' ELSE 'null' END""", "ts_updated_at"),
    Slot("""'"subscription":{"amount":' || CASE WHEN k % 6 = 0 THEN '{"x":1}' ELSE '12.5' END""", "imp_subscription_amount", "k % 6 = 0"),
    Slot("""'"ordersInCycle":' || CASE WHEN k % 4 = 0 THEN '[null,"n/a"]' ELSE '3' END || '}'""", "val_orders_in_cycle", "k % 4 = 0"),
    Slot("""'"legacyId":' || CASE WHEN k % 5 = 0 THEN '"none"' ELSE CAST(k AS STRING) END""", "val_legacy_id", "k % 5 = 0"),
)
DOCUMENT = " || ',' || ".join(["""'{"_id":"c' || CAST(k AS STRING) || '"'""", *[s.text for s in SLOTS]]) + " || '}'"
ENVELOPE = f"""'{{"operation":"insert","collection":"customers","timestamp":"2024-01-03T00:00:00Z","document":' || {DOCUMENT} || '}}'"""


def messages(spark, sf_dir):
    """One message per customer, every third one delivered twice."""
    customers = table(prepare(spark), sf_dir, "customer").selectExpr("c_custkey AS k")
    delivered = customers.selectExpr("*", "explode(sequence(1, if(k % 3 = 0, 2, 1))) AS delivery")
    none = "CAST(NULL AS map<string,string>)"
    return delivered.selectExpr(
        f"named_struct('data', base64(encode({ENVELOPE}, 'UTF-8')), 'attributes', {none}, 'messageId', concat('c-', k), 'message_id', CAST(NULL AS string)) AS message",
        "CAST(NULL AS string) AS data", f"{none} AS attributes", "CAST(NULL AS string) AS messageId", "CAST(NULL AS timestamp) AS publishTime", "1 AS delivery_attempt",
    )


def batch(spark, sf_dir):
    """The drift sink of a batch run, run twice."""
    out = work_dir(prepare(spark), "tables")
    for _ in range(2):
        written = write_all_tables(messages(spark, sf_dir), out, work_dir(spark, "routed"), as_of())
    return read_drift(spark, out, written)


def streamed(spark, sf_dir):
    """The drift sink of a stream of the same messages, in several micro-batches and after a restart."""
    source, out, mark = (work_dir(prepare(spark), n) for n in ("messages", "tables", "checkpoint"))
    rows = messages(spark, sf_dir)
    rows.repartition(3).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source)
        ST.transform_consumer(stream, out, work_dir(spark, "routed"), mark, as_of()).awaitTermination()
    return read_drift(spark, out, ["customers"])


_LOST = ", ".join(f"CASE WHEN {s.lost} THEN '{s.target}' END" for s in SLOTS)
DOCUMENT_SQL = f"""
WITH c AS (SELECT c_custkey AS k FROM customer),
d AS (SELECT k, list_filter([{_LOST}], lambda x: x IS NOT NULL) AS lost FROM c),
m AS (SELECT k, list_append(list_transform(lost, lambda f: 'TYPE_MISMATCH: COLUMN_CAST_FAILED for ''' || f || ''' in 1 rows'),
    'RECOVERY: Dropped columns due to errors: [' || array_to_string(list_transform(lost, lambda f: '''' || f || ''''), ', ') || ']') AS messages FROM d WHERE len(lost) > 0)
SELECT CAST(unnest(range(len(messages))) AS INT) AS position, unnest(messages) AS message, 'customers' AS collection, 'WARNING' AS severity,
  TIMESTAMP '{AS_OF}' AS timestamp, 'c' || k AS document_id, 'c-' || k AS message_id, CAST(0 AS INT) AS pos FROM m"""


def batch_sql() -> str:
    """Warnings about the whole batch: columns added and dropped, null shares, lost values by column."""
    customers = REGISTRY["customers"]
    names = [name for name, _ in customers.target_columns]
    fixed = [f"SCHEMA_DRIFT: Added missing field ''{f.target}'' ({ {'boolean': 'bool'}.get(f.as_type, f.as_type) }) with None" for f in customers.fields if f.source is None]
    fixed.append("SCHEMA_DRIFT: Dropping unexpected fields: {" + ", ".join(sorted(f"''{f.target}''" for f in customers.dropped)) + "}")
    lost = {s.target: s.lost for s in SLOTS if s.lost != "false"}
    always = {"pk_client", "pk_yearmonth", "des_data_origin", "des_source", "val_active_orders_count"}
    parts = [(i, f"'{text}'", "true") for i, text in enumerate(fixed)]
    parts += [(len(fixed) + i, f"'DATA_QUALITY: Field ''{name}'' has 100.0% null values'", "true") for i, name in enumerate(names) if name not in always and name not in lost]
    parts += [(len(fixed) + names.index(name), f"'TYPE_MISMATCH: COLUMN_CAST_FAILED for ''{name}'' in ' || count_if({when}) || ' rows'", when) for name, when in lost.items()]
    told = " UNION ALL ".join(f"SELECT {i} AS position, {text} AS message FROM c HAVING count_if({when}) > 0" for i, text, when in parts)
    return (
        f"WITH c AS (SELECT c_custkey AS k FROM customer) SELECT position, message, 'customers' AS collection, "
        f"CASE WHEN contains(message, 'DATA_QUALITY') THEN 'INFO' ELSE 'WARNING' END AS severity, TIMESTAMP '{AS_OF}' AS timestamp FROM ({told})"
    )


QUERIES = {
    "drift_rows": (lambda spark, sf_dir: batch(spark, sf_dir).filter("document_id IS NOT NULL"), DOCUMENT_SQL),
    "drift_rows_stream": (lambda spark, sf_dir: streamed(spark, sf_dir).filter("document_id IS NOT NULL"), DOCUMENT_SQL),
    "drift_batch_report": (
        lambda spark, sf_dir: batch(spark, sf_dir).filter("document_id IS NULL").select("position", "message", "collection", "severity", "timestamp"),
        batch_sql(),
    ),
}
