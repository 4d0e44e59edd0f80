"""Shape dispatch, collection routing and dispositions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V

UNKNOWN = "unknown"
NULL_DOCUMENT = "null_document"
PROCESSED = "processed"
SKIPPED = "skipped"


def _named(holder: str) -> str:
    """The ``collection`` member, unless it is absent or says unknown."""
    return f"nullif({V.get_keys(holder, 'collection', as_type='string')}, '{UNKNOWN}')"


def _inferred(document: str, default: str) -> str:
    """Collection guessed from a document's own members."""

    def has(key: str) -> str:
        return f"{V.get_keys(document, key)} IS NOT NULL"

    return (
        f"CASE WHEN {V.cast_to(document, 'map<string,variant>')} IS NULL THEN '{UNKNOWN}' "
        f"WHEN {has('email')} AND ({has('subscription')} OR {has('createdAt')}) THEN 'customers' "
        f"ELSE '{default}' END"
    )


def dispatch(decoded: DataFrame) -> DataFrame:
    """One row per document.

    An envelope gives its ``document``; any other object is its own document; a list gives a
    row per element, all routed by the first.  Messages that failed to decode keep one row
    without a document.
    """
    shaped = decoded.selectExpr("*", f"{V.cast_to('event', 'array<variant>')} AS _list")
    inside = V.get_keys("event", "document")
    stamp = V.get_keys("event", "timestamp", as_type="string")
    columns = ("message_id", "attributes", "publish_time", "decode_error", "operation", "correlation_id", "event_ts", "_named")
    # A document is copied out of its envelope here, once; the generator keeps what is routed by from copying it again.
    taken = shaped.selectExpr(
        *columns[:4],
        f"{V.get_keys('event', 'operation', as_type='string')} AS operation",
        f"{V.get_keys('event', 'correlation_id', as_type='string')} AS correlation_id",
        f"{V.iso_time(stamp)} AS event_ts",
        f"if(_list IS NULL, {_named('event')}, NULL) AS _named",
        f"if(_list IS NOT NULL, _list, array(coalesce({inside}, event))) AS _documents",
        "if(array_size(_list) = 0, event, NULL) AS _empty",
    )
    return taken.selectExpr(
        *columns, "coalesce(get(_documents, 0), _empty) AS _first", "posexplode_outer(_documents) AS (pos, document)"
    )


def route(dispatched: DataFrame, supported: Iterable[str], default: str) -> DataFrame:
    """Adds ``collection`` and ``disposition`` to every document."""
    guessed = f"coalesce(_named, {_named('_first')}, {_inferred('_first', default)})"
    routed = dispatched.selectExpr(
        "*", f"if(decode_error IS NULL, {guessed}, NULL) AS collection"
    )
    missing = F.expr(V.is_null("document"))
    disposition = (
        F.when(F.col("decode_error").isNotNull(), F.col("decode_error"))
        .when(~F.col("collection").isin(*sorted(supported)), F.concat(F.lit(f"{SKIPPED}_"), "collection"))
        .when(missing, NULL_DOCUMENT)
        .otherwise(PROCESSED)
    )
    named = F.struct(
        "collection",
        disposition.alias("disposition"),
        F.coalesce(
            "operation", F.try_element_at("attributes", F.lit("operation")), F.lit(UNKNOWN)
        ).alias("operation"),
        F.coalesce(
            "correlation_id", F.try_element_at("attributes", F.lit("correlation_id"))
        ).alias("correlation_id"),
        F.coalesce("event_ts", "publish_time").alias("event_ts"),
    )
    # A generator keeps later filters on these columns above it: pushed further down they
    # would decode and parse each message once more per predicate.
    return routed.select("message_id", "pos", "document", F.inline(F.array(named)))


def processed(routed: DataFrame, collection: str | None = None) -> DataFrame:
    wanted = F.col("disposition") == PROCESSED
    if collection is not None:
        wanted = wanted & (F.col("collection") == collection)
    return routed.filter(wanted)


def skipped(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("disposition").startswith(f"{SKIPPED}_"))


def rejected(routed: DataFrame) -> DataFrame:
    done = (F.col("disposition") == PROCESSED) | F.col("disposition").startswith(f"{SKIPPED}_")
    return routed.filter(~done)


def detailed_log_rows(routed: DataFrame, collections: Iterable[str]) -> DataFrame:
    """Rows of the collections chosen for detailed logging; an empty choice keeps all."""
    chosen = list(collections)
    return routed.filter(F.col("collection").isin(*chosen)) if chosen else routed


def shape_profile(routed: DataFrame, watched: dict[str, str], sample_length: int = 500) -> DataFrame:
    """Per-document diagnostics: key list, key count, kind of each watched path, sample text."""
    keys = f"array_sort(map_keys({V.cast_to('document', 'map<string,variant>')}))"

    def kind(path: str) -> str:
        schema = V.kind_of(V.get_path("document", path))
        return (
            f"CASE WHEN {schema} IS NULL THEN 'absent' WHEN startswith({schema}, 'ARRAY') THEN 'array' "
            f"WHEN startswith({schema}, 'OBJECT') THEN 'object' ELSE 'scalar' END"
        )

    return routed.selectExpr(
        "message_id",
        "collection",
        f"{keys} AS keys",
        f"array_size({keys}) AS key_count",
        *[f"{kind(path)} AS {name}" for name, path in watched.items()],
        f"substring(to_json(document), 1, {sample_length}) AS sample",
    )


def collection_shapes(routed: DataFrame) -> DataFrame:
    """The merged document schema of each collection."""
    return routed.groupBy("collection").agg(
        F.schema_of_variant_agg("document").alias("document_schema"),
        F.count(F.lit(1)).alias("documents"),
    )
