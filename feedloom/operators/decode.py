"""Message decoding: base64, double wrapping, extended JSON and format errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V

BAD_REQUEST = "bad_request"
FORMAT_ERROR = "format_error"
UNEXPECTED_ERROR = "unexpected_error"


def parse_payload(payload: str) -> str:
    """VARIANT of a UTF-8 JSON payload, NULL where it is neither."""
    text = f"CAST({payload} AS string)"
    return f"try_parse_json(if(is_valid_utf8({text}), {text}, NULL))"


def decode(messages: DataFrame) -> DataFrame:
    """Messages to ``message_id, attributes, publish_time, data, payload, event, decode_error, has_payload``.

    ``data`` is the text as it was delivered, ``payload`` keeps the untouched bytes, ``event`` is their VARIANT form.  A payload that
    itself is a wrapped message is opened once more, and its id and attributes win.
    ``decode_error`` is NULL, ``bad_request`` (no data, or no JSON) or ``format_error``.
    """
    inner_data = V.get_keys("event", "message", "data", as_type="string")
    inner_id = V.get_keys("event", "message", "messageId", as_type="string")
    inner_attributes = V.get_keys("event", "message", "attributes", as_type="map<string,string>")
    return (
        messages.selectExpr(
            "coalesce(message.data, data) AS data",
            "coalesce(message.attributes, attributes) AS attributes",
            "coalesce(message.messageId, message.message_id, messageId, '') AS message_id",
            "publishTime AS publish_time",
        )
        .selectExpr("*", "try_to_binary(data, 'base64') AS payload")
        .selectExpr("*", f"{parse_payload('payload')} AS event")
        .selectExpr(
            "*",
            f"if({inner_data} IS NOT NULL, named_struct("
            f"'payload', try_to_binary({inner_data}, 'base64'), 'id', {inner_id}, "
            f"'attributes', {inner_attributes}), NULL) AS inner_message",
        )
        .selectExpr(
            "coalesce(inner_message.id, message_id) AS message_id",
            "coalesce(inner_message.attributes, attributes) AS attributes",
            "publish_time",
            "data",
            "coalesce(data, '') = '' AS no_data",
            "CASE WHEN coalesce(data, '') = '' THEN NULL WHEN inner_message IS NOT NULL "
            "THEN inner_message.payload ELSE payload END AS payload",
            f"if(inner_message IS NOT NULL, {parse_payload('inner_message.payload')}, event) AS event",
        )
        # The generator is a fence: a later filter on its columns stays above it.  Pushed
        # below, it would decode and parse every message once more.
        .selectExpr(
            "message_id",
            "attributes",
            "publish_time",
            "data",
            "payload",
            "event",
            f"inline(array(named_struct('decode_error', CASE WHEN no_data THEN '{BAD_REQUEST}' "
            f"WHEN payload IS NULL THEN '{FORMAT_ERROR}' WHEN event IS NULL THEN '{BAD_REQUEST}' END, "
            "'has_payload', payload IS NOT NULL)))",
        )
    )


def named_messages(decoded: DataFrame) -> DataFrame:
    """Gives messages without an id the digest of their payload (of what was delivered, where there is none).

    Different messages without an id thus stay apart, and a copy of one is still known as such.
    """
    content = F.coalesce(F.base64("payload"), F.nullif("data", F.lit("")), F.to_json("attributes"), F.lit(""))
    own = F.concat(F.lit("sha256:"), F.sha2(content, 256))
    return decoded.withColumn("message_id", F.coalesce(F.nullif("message_id", F.lit("")), own))


def is_retryable(error_type: Column) -> Column:
    """Format errors are acknowledged; anything else is delivered again."""
    return ~error_type.isin(BAD_REQUEST, FORMAT_ERROR)


def error_records(decoded: DataFrame, bucket: str, as_of: Column | None = None) -> DataFrame:
    """The error-context record of every message that could not be decoded.

    ``original_event`` holds the message as delivered, so that it can be sent again.
    """
    at = F.current_timestamp() if as_of is None else as_of
    failed = decoded.filter(F.col("decode_error").isNotNull())
    return failed.select(
        F.when(F.col("decode_error") == BAD_REQUEST, "no usable data in message")
        .otherwise("message data is not base64")
        .alias("error"),
        F.col("decode_error").alias("error_type"),
        at.alias("timestamp"),
        F.to_json(F.struct(F.col("message_id").alias("messageId"), "attributes", "data", F.col("publish_time").alias("publishTime"))).alias("original_event"),
        F.lit(bucket).alias("bucket"),
        F.concat(
            F.lit("errors/"), F.date_format(at, "yyyy-MM-dd"), F.lit("/"),
            F.coalesce(F.nullif("message_id", F.lit("")), F.lit("unknown")), F.lit("_"),
            F.unix_timestamp(at).cast("string"), F.lit(".json"),
        ).alias("path"),
        F.to_date(at).alias("error_date"),
        is_retryable(F.col("decode_error")).alias("retryable"),
        "message_id",
    )


def route_by_attempts(messages: DataFrame, limit: int = 5) -> DataFrame:
    """Marks messages whose delivery attempts are used up for the dead-letter path."""
    spent = F.coalesce(F.col("delivery_attempt"), F.lit(1)) >= limit
    return messages.withColumn("delivery_route", F.when(spent, "dead_letter").otherwise("process"))


def with_attribute(messages: DataFrame, name: str, value: str) -> DataFrame:
    """Subscription filter: messages whose attribute has the value."""
    return messages.filter(F.try_element_at("attributes", F.lit(name)) == value)
