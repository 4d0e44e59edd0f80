"""The sample documents of all 22 collections and their transform queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ingest import CARRIED, collection_table
from ..session import prepare, table
from .samples import Sample, as_of, rounded

HOURS = "TIMESTAMP '2023-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(k % 100000 AS INT)"


def _simple(tbl: str, key: str, prefix: str, text: str, number: str, extra: str = "") -> str:
    """Base rows straight from one table, with times counted from the key."""
    return (
        f"SELECT k, '{prefix}' || CAST(k AS STRING) AS id, {HOURS} AS t, s, x{extra} "
        f"FROM (SELECT *, CAST({key} AS BIGINT) AS k, {text} AS s, CAST({number} AS DOUBLE) AS x "
        f"FROM {{{tbl}}}) rows_of_{tbl}"
    )


# --- customers, leads and their archive ---------------------------------------------------

CUSTOMER_BASE = """
SELECT CAST(c_custkey AS BIGINT) AS k, 'cust_' || CAST(c_custkey AS STRING) AS id,
       coalesce(first_order, TIMESTAMP '1999-01-01 00:00:00') AS t,
       c_mktsegment AS s, c_acctbal AS x, coalesce(n_status, 0) AS n_status
FROM {customer} LEFT JOIN (
  SELECT o_custkey, min(o_orderdate) AS first_order, count(DISTINCT o_orderstatus) AS n_status
  FROM {orders} GROUP BY o_custkey) o ON c_custkey = o_custkey
"""

# Dogs: none (absent), then 0 to 3 of them; the second one's weight is text, the third is unusable.
DOGS = (
    "CASE WHEN k % 5 = 4 THEN NULL ELSE concat('[', concat_ws(',', transform("
    "filter(sequence(1, 4), i -> i <= k % 5), i -> concat('{\"name\":', "
    "if(i = 2, '[\"\",\"', '\"'), 'dog', i, '-', k % 10, if(i = 2, '\"]', '\"'), "
    "',\"weight\":', CASE i WHEN 1 THEN CAST(k % 30 AS string) WHEN 2 THEN '\"2.5\"' "
    "ELSE '\"heavy\"' END, '}'))), ']') END"
)
DOG_EXPECT = {
    "val_dogs_count": "CASE WHEN k % 5 < 4 THEN k % 5 END",
    "txt_dog_names": (
        "CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN 'dog1-' || k % 10 "
        "WHEN 2 THEN 'dog1-' || k % 10 || ', dog2-' || k % 10 "
        "WHEN 3 THEN 'dog1-' || k % 10 || ', dog2-' || k % 10 || ', dog3-' || k % 10 END"
    ),
    "val_total_dog_weight": (
        "CASE WHEN k % 5 = 1 AND k % 30 > 0 THEN k % 30 WHEN k % 5 IN (2, 3) THEN k % 30 + 2.5 END"
    ),
}


def _presence(key: str, shift: int) -> tuple[str, str]:
    """A slot that is absent, empty text, an empty object, an object, or a list of blanks."""
    json = (
        f"CASE (k + {shift}) % 5 WHEN 0 THEN NULL WHEN 1 THEN '\"\"' WHEN 2 THEN '{{}}' "
        f"WHEN 3 THEN '{{\"{key}\":1}}' ELSE '[\"\",null]' END"
    )
    expected = f"CASE (k + {shift}) % 5 WHEN 1 THEN false WHEN 3 THEN true WHEN 4 THEN false END"
    return json, expected


SAMPLES: dict[str, Sample] = {}


def _add(sample: Sample) -> None:
    SAMPLES[sample.collection] = sample


_add(
    Sample(
        "customers",
        CUSTOMER_BASE,
        values={
            "email": "'c' || CAST(k AS STRING) || '@example.org'",
            "subscription.amount": "x",
            "legacyId": "k",
        },
        raw={
            "dogs": DOGS,
            "subscription.activeOrders": (
                "if(n_status = 0, NULL, to_json(transform(sequence(1, n_status), i -> concat('order-', i))))"
            ),
            "internalComments": (
                "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '[]' ELSE concat('[{\"date\":\"', "
                "date_format(t, 'yyyy-MM-dd'), '\"},{\"date\":\"2024-13-01\"},{\"date\":{\"$date\":\"', "
                "date_format(t + INTERVAL '2' DAY, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '\"}}]') END"
            ),
            "acquisition": "if(k % 2 = 0, '{\"first\":{\"source\":\"web\"}}', NULL)",
        },
        expect={
            **DOG_EXPECT,
            "val_active_orders_count": "n_status",
            "val_internal_comments_count": "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 3 END",
            "ts_last_internal_comment": "CASE WHEN k % 4 > 1 THEN t + INTERVAL '2' DAY END",
        },
    )
)

_add(
    Sample(
        "leads",
        _simple("customer", "c_custkey", "lead_", "c_mktsegment", "c_acctbal"),
        values={"email": "'lead' || CAST(k AS STRING) || '@example.org'", "trialAmount": "x"},
        raw={"dogs": DOGS, "paymentLog": _presence("log", 0)[0]},
    )
)

_add(
    Sample(
        "leads-archive",
        _simple("customer", "c_custkey", "lead_", "c_mktsegment", "c_acctbal"),
        values={"subscriptionAmount": "x"},
        raw={
            "dogs": DOGS,
            "sales": (
                "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '\"closed\"' "
                "WHEN 2 THEN '{\"comments\":[1,2,3],\"status\":[\"\",\"won\"]}' "
                "ELSE concat('{\"status\":\"open\",\"reassignmentCount\":\"', k % 9, "
                "'\",\"assignedAt\":{\"$date\":\"', date_format(t, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '\"}}') END"
            ),
            "acquisition": _presence("first", 1)[0],
            "sharedInfo": _presence("by", 2)[0],
            "subscription": _presence("status", 3)[0],
            "address": _presence("line1", 4)[0],
            "paymentLog": _presence("log", 5)[0],
            "emailDeliverability": _presence("ok", 6)[0],
        },
        expect={
            **DOG_EXPECT,
            "des_sales_status": "CASE k % 4 WHEN 2 THEN 'won' WHEN 3 THEN 'open' END",
            "ts_sales_assigned_at": "CASE WHEN k % 4 = 3 THEN t END",
            "val_sales_reassignment_count": "CASE k % 4 WHEN 0 THEN NULL WHEN 3 THEN k % 9 ELSE 0 END",
            "val_sales_comments_count": "CASE k % 4 WHEN 0 THEN NULL WHEN 2 THEN 3 ELSE 0 END",
            "flg_has_acquisition_data": _presence("", 1)[1],
            "flg_has_shared_info": _presence("", 2)[1],
            "flg_has_subscription_data": _presence("", 3)[1],
            "flg_has_address": _presence("", 4)[1],
            "flg_has_payment_log": _presence("", 5)[1],
        },
    )
)

_add(
    Sample(
        "users-metadata",
        _simple("customer", "c_custkey", "cust_", "c_mktsegment", "c_acctbal"),
        values={"password": "md5('p' || CAST(k AS STRING))", "verificationToken": "md5('t' || CAST(k AS STRING))"},
    )
)

# --- orders and packages ------------------------------------------------------------------

# Bag sizes and meats of an order.
SIZES = ("100", "300", "400", "500")
MEATS = ("chicken", "salmon", "beef", "turkey")


def _bag_sums() -> str:
    return ", ".join(
        f"sum(CASE WHEN l_linenumber % 4 = {i} AND l_partkey % 4 = {j} "
        f"THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS q_{size}_{meat}"
        for i, size in enumerate(SIZES)
        for j, meat in enumerate(MEATS)
    )


ORDER_BASE = f"""
SELECT CAST(o_orderkey AS BIGINT) AS k, 'ord_' || CAST(o_orderkey AS STRING) AS id, o_orderdate AS t,
       o_orderpriority AS s, o_totalprice AS x, o_orderstatus, o_custkey, bags.*
FROM {{orders}} LEFT JOIN (
  SELECT l_orderkey, {_bag_sums()} FROM {{lineitem}} GROUP BY l_orderkey) bags ON o_orderkey = l_orderkey
"""


def _bag_json() -> str:
    """bagList of sizes to meats; counts of odd sizes are text, one meat is wrapped in a list."""
    sizes = []
    for i, size in enumerate(SIZES):
        quote = '"' if i % 2 else ""
        meats = ",".join(
            f"\"{meat}\":{'[null,' if j == 3 else ''}{quote}', q_{size}_{meat}, '{quote}{']' if j == 3 else ''}"
            for j, meat in enumerate(MEATS)
        )
        sizes.append(f"\"{size}\":{{{meats}}}")
    return "{\"bagList\":{" + ",".join(sizes) + "},\"extras\":[1,2]}"


def _bags(of: list[tuple[str, str]]) -> str:
    total = " + ".join(f"q_{size}_{meat}" for size, meat in of)
    return f"CASE WHEN l_orderkey IS NOT NULL THEN {total} WHEN k % 3 = 0 THEN 0 END"


_add(
    Sample(
        "orders",
        ORDER_BASE,
        values={"status": "o_orderstatus", "custId": "'cust_' || CAST(o_custkey AS STRING)"},
        raw={
            "content": (
                f"CASE WHEN l_orderkey IS NOT NULL THEN concat('{_bag_json()}') "
                "WHEN k % 3 = 0 THEN '{\"extras\":[]}' END"
            ),
            "package.handlers": "if(k % 3 = 0, NULL, to_json(transform(sequence(1, k % 3), i -> i)))",
        },
        expect={
            "val_package_handlers_count": "k % 3",
            "val_total_bags": _bags([(a, b) for a in SIZES for b in MEATS]),
            **{f"val_{m}_bags": _bags([(a, m) for a in SIZES]) for m in MEATS},
            **{f"val_bag_size_{a}_count": _bags([(a, m) for m in MEATS]) for a in SIZES},
        },
    )
)

_add(
    Sample(
        "orders-archive",
        "SELECT CAST(o_orderkey AS BIGINT) AS k, 'ord_' || CAST(o_orderkey AS STRING) AS id, o_orderdate AS t, "
        "o_orderpriority AS s, o_totalprice AS x, o_orderstatus FROM {orders}",
        values={"status": "o_orderstatus", "package.totalWeightKg": "x"},
    )
)

_add(
    Sample(
        "deliveries",
        _simple("documents", "doc_id", "del_", "lang", "n_chars", ", text"),
        raw={
            "labelData": "CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN '\"\"' "
            "ELSE substring(to_json(array(text)), 2, length(to_json(array(text))) - 2) END",
            "internalLabelData": "if(k % 3 = 0, to_json(array('', text)), NULL)",
        },
        expect={
            "flg_has_label_data": "CASE k % 4 WHEN 0 THEN NULL ELSE k % 4 > 1 AND text <> '' END",
            "val_label_data_length": "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE length(text) END",
            "flg_has_internal_label_data": "CASE WHEN k % 3 = 0 THEN text <> '' END",
            "val_internal_label_data_length": "CASE WHEN k % 3 = 0 THEN length(text) END",
        },
    )
)

_add(
    Sample(
        "packages",
        _simple("part", "p_partkey", "pkg_", "p_type", "p_retailprice", ", p_size"),
        values={"bagCount": "p_size"},
        raw={"usedAt": "if(k % 3 = 0, NULL, concat('\"', date_format(t, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '\"'))"},
        expect={
            "ts_used_at": "CASE WHEN k % 3 > 0 THEN t END",
            "flg_is_used": "CASE WHEN k % 3 > 0 THEN true END",
        },
    )
)

# --- payments -----------------------------------------------------------------------------

LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_returnflag, l_linestatus"
PAYMENT_BASE = f"""
SELECT CAST(o_orderkey AS BIGINT) AS k, 'pay_' || CAST(o_orderkey AS STRING) || CASE WHEN grain > 0 THEN '-' || grain ELSE '' END AS id, o_orderdate AS t,
       o_orderpriority AS s, o_totalprice AS x, o_orderstatus, o_custkey, items.*
FROM {{orders}} LEFT JOIN (
  SELECT l_orderkey, l_linenumber // 1000 AS grain, count(*) AS n_lines, sum(CAST(l_quantity AS BIGINT)) AS qty,
         sum(CAST(l_quantity AS BIGINT) * (l_suppkey % 40 * 25)) AS grams,
         sum(CAST(l_quantity AS BIGINT) * l_extendedprice) AS amount,
         string_agg('part-' || l_partkey, ', ' ORDER BY {LINE_ORDER}) AS products,
         string_agg('o-' || l_suppkey, ', ' ORDER BY {LINE_ORDER}) AS linked,
         count(*) FILTER (l_returnflag = 'R') AS n_refunds,
         sum(l_extendedprice) FILTER (l_returnflag = 'R') AS refunded,
         first(l_linestatus ORDER BY l_shipdate DESC, {LINE_ORDER}) FILTER (l_returnflag = 'R') AS refund_status,
         first('reason-' || l_suppkey % 5 ORDER BY l_shipdate DESC, {LINE_ORDER}) FILTER (l_returnflag = 'R') AS refund_reason
  FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber // 1000) items ON o_orderkey = l_orderkey
"""


def _payment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines as a sorted array, one document for every thousand line numbers of an order."""
    columns = [c.strip() for c in LINE_ORDER.split(",")]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *columns)
    grouped = lines.groupBy("l_orderkey", F.expr("CAST(l_linenumber AS BIGINT) DIV 1000").alias("grain")).agg(
        F.array_sort(F.collect_list(F.struct(*columns))).alias("lines")
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(grouped, orders.o_orderkey == grouped.l_orderkey, "left").selectExpr(
        "CAST(o_orderkey AS BIGINT) AS k",
        "concat('pay_', o_orderkey, if(grain > 0, concat('-', grain), '')) AS id",
        "o_orderdate AS t",
        "o_orderpriority AS s",
        "o_totalprice AS x",
        "o_orderstatus",
        "o_custkey",
        "lines",
    )


PAYMENT_RAW = {
    "lineItems": (
        "CASE WHEN lines IS NOT NULL THEN to_json(transform(lines, l -> named_struct("
        "'product', concat('part-', l.l_partkey), 'qty', CAST(l.l_quantity AS int), "
        "'unitAmount', l.l_extendedprice, 'unitGrams', CAST(l.l_suppkey % 40 * 25 AS string)))) "
        "WHEN k % 2 = 1 THEN '[]' END"
    ),
    "orders": (
        "CASE WHEN lines IS NOT NULL THEN to_json(transform(lines, l -> concat('o-', l.l_suppkey))) "
        "WHEN k % 2 = 1 THEN '[]' END"
    ),
    "refunds": (
        "CASE WHEN lines IS NOT NULL THEN to_json(transform(filter(lines, l -> l.l_returnflag = 'R'), l -> named_struct("
        "'amount', CAST(l.l_extendedprice AS string), 'createdAt', named_struct('$date', "
        "date_format(l.l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")), 'status', array('', l.l_linestatus), "
        "'reason', named_struct('category', concat('reason-', l.l_suppkey % 5))))) "
        "WHEN k % 2 = 1 THEN '[]' END"
    ),
}


def _lines(value: str, empty: str) -> str:
    return f"CASE WHEN l_orderkey IS NOT NULL THEN {value} WHEN k % 2 = 1 THEN {empty} END"


PAYMENT_EXPECT = {
    "val_linked_orders_count": _lines("n_lines", "0"),
    "txt_linked_order_ids": _lines("linked", "''"),
    "val_line_items_count": _lines("n_lines", "0"),
    "val_total_product_qty": _lines("qty", "0"),
    "val_total_product_grams": _lines("grams", "0"),
    "imp_line_items_total_amount": _lines("amount", "0"),
    "txt_products_list": _lines("products", "''"),
    "val_refunds_count": _lines("n_refunds", "0"),
    "imp_total_refund_amount": _lines("coalesce(refunded, 0)", "0"),
    "des_latest_refund_status": "refund_status",
    "des_latest_refund_reason": "refund_reason",
}
PAYMENT_VALUES = {
    "status": "o_orderstatus",
    "amount": "x",
    "custId": "'cust_' || CAST(o_custkey AS STRING)",
}

_add(Sample("payments", PAYMENT_BASE, _payment_rows, PAYMENT_VALUES, PAYMENT_RAW, PAYMENT_EXPECT))
_add(
    Sample(
        "payments-archive",
        PAYMENT_BASE,
        _payment_rows,
        PAYMENT_VALUES,
        {name: PAYMENT_RAW[name] for name in ("lineItems", "orders")},
        PAYMENT_EXPECT,
    )
)
_add(
    Sample(
        "coupons",
        _simple("part", "p_partkey", "CODE", "p_brand", "p_retailprice", ", p_type"),
        values={"type": "p_type"},
    )
)

# --- contacts, retention, notifications ---------------------------------------------------

CONTACT_BASE = """
SELECT conv_id AS k, 'contact_' || CAST(conv_id AS STRING) || CASE WHEN turn // 1000 > 0 THEN '-' || (turn // 1000) ELSE '' END AS id,
       TIMESTAMP '2023-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(conv_id % 100000 AS INT) AS t, 'conv' AS s, 1.0 AS x,
       count(*) AS n_logs, sum(length(text)) AS duration,
       count(*) FILTER (turn % 3 = 0) AS calls, count(*) FILTER (turn % 3 = 1) AS emails,
       count(*) FILTER (turn % 3 = 2) AS texts,
       max(turn) AS last_turn, arg_max(role, turn) AS last_role, arg_max(length(text), turn) AS last_length
FROM {conversations} GROUP BY conv_id, turn // 1000
"""


def _contact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "role", "length(text) AS chars"
    )
    grouped = turns.groupBy("conv_id", F.expr("turn DIV 1000").alias("grain")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "chars"))).alias("turns")
    )
    return grouped.selectExpr(
        "conv_id AS k",
        "concat('contact_', conv_id, if(grain > 0, concat('-', grain), '')) AS id",
        "TIMESTAMP '2023-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(conv_id % 100000 AS INT) AS t",
        "'conv' AS s",
        "1D AS x",
        "turns",
    )


_add(
    Sample(
        "contacts-logs",
        CONTACT_BASE,
        _contact_rows,
        raw={
            "logs": (
                "to_json(transform(turns, e -> named_struct("
                "'eventType', CASE e.turn % 3 WHEN 0 THEN 'call' WHEN 1 THEN 'email' ELSE 'sms' END, "
                "'direction', e.role, 'status', array('', concat('st-', e.turn % 4)), "
                "'agent', concat('agent-', e.turn % 7), 'duration', CAST(e.chars AS string), "
                "'startedAt', date_format(t + INTERVAL '1' MINUTE * CAST(e.turn AS int), "
                "\"yyyy-MM-dd'T'HH:mm:ss'Z'\"))))"
            )
        },
        expect={
            "val_logs_count": "n_logs",
            "val_total_call_duration": "duration",
            "val_call_count": "calls",
            "val_email_count": "emails",
            "val_sms_count": "texts",
            "ts_last_contact": "t + INTERVAL '1' MINUTE * CAST(last_turn AS INT)",
            "des_last_contact_type": "CASE last_turn % 3 WHEN 0 THEN 'call' WHEN 1 THEN 'email' ELSE 'sms' END",
            "des_last_contact_direction": "last_role",
            "des_last_contact_status": "'st-' || last_turn % 4",
            "val_last_contact_duration": "last_length",
            "fk_last_contact_agent": "'agent-' || last_turn % 7",
        },
    )
)

_add(
    Sample(
        "retentions",
        _simple("customer", "c_custkey", "ret_", "c_mktsegment", "c_acctbal"),
        raw={
            "contactChannels": (
                "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '[\"phone\",\"\",[\"\",\"mail\"]]' ELSE '\"phone\"' END"
            ),
            "reasonForPause": (
                "CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN concat('{\"category\":\"cat-', k % 8, "
                "'\",\"subcategory\":[null,\"sub-', k % 5, '\"],\"comebackProbab\":\"0.', k % 90 + 10, '\"}') "
                "ELSE concat('[{\"category\":\"cat-', k % 8, '\",\"comebackProbab\":0.5}]') END"
            ),
        },
        expect={
            "val_contact_channels_count": "CASE k % 4 WHEN 1 THEN 0 WHEN 2 THEN 3 WHEN 3 THEN 0 END",
            "txt_contact_channels": "CASE k % 4 WHEN 1 THEN '' WHEN 2 THEN 'phone, mail' WHEN 3 THEN '' END",
            "des_pause_reason_category": "CASE WHEN k % 3 > 0 THEN 'cat-' || k % 8 END",
            "des_pause_reason_subcategory": "CASE WHEN k % 3 = 1 THEN 'sub-' || k % 5 END",
            "val_comeback_probability": "CASE k % 3 WHEN 1 THEN CAST('0.' || (k % 90 + 10) AS DOUBLE) WHEN 2 THEN 0.5 END",
        },
    )
)

EVENT_BASE = (
    "SELECT event_id AS k, '{prefix}' || CAST(event_id AS STRING) AS id, date_trunc('second', ts) AS t, "
    "event_type AS s, value AS x, user_id FROM {{events}}"
)

_add(
    Sample(
        "notifications",
        EVENT_BASE.format(prefix="not_"),
        values={"notificationType": "s", "recipient": "'cust_' || CAST(user_id AS STRING)"},
        raw={
            "readAt": (
                "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '\"\"' WHEN 2 THEN '\"soon\"' "
                "ELSE concat('{\"$date\":\"', date_format(t, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '\"}') END"
            )
        },
        expect={
            "ts_read_at": "CASE WHEN k % 4 = 3 THEN t END",
            "flg_is_read": "CASE WHEN k % 4 > 0 THEN k % 4 > 1 END",
        },
    )
)

_add(
    Sample(
        "appointments",
        EVENT_BASE.format(prefix="app_"),
        values={"leadId": "'lead_' || CAST(user_id AS STRING)"},
    )
)

_add(
    Sample(
        "engagement-histories",
        _simple("labels", "doc_id", "eng_", "'q' || CAST(quality AS STRING)", "toxic", ", quality, toxic"),
        raw={
            "cust.recommendationData.dailyGrams": (
                "CASE WHEN quality = 1 THEN concat('[', k, ',2]') WHEN toxic = 1 THEN '[]' END"
            ),
            "cust.recommendationData.menus": "CASE k % 3 WHEN 0 THEN '[{\"m\":1}]' WHEN 1 THEN '\"\"' END",
        },
        expect={
            "flg_has_daily_grams_recommendations": "coalesce(quality = 1, false)",
            "flg_has_menu_recommendations": "k % 3 = 0",
        },
    )
)

# --- change logs --------------------------------------------------------------------------

ENTITY_IDS = "CASE user_id % 9 WHEN 0 THEN 'ord_' WHEN 1 THEN 'cust_' WHEN 2 THEN 'pay_' WHEN 3 THEN 'lead_' WHEN 4 THEN 'lds_' WHEN 5 THEN 'sub_' WHEN 6 THEN 'del_' WHEN 7 THEN 'order' ELSE 'x_' END"

CHANGE_BASE = f"""
SELECT g.user_id AS k, {ENTITY_IDS.replace('user_id', 'g.user_id')} || CAST(g.user_id AS STRING) || CASE WHEN g.grain > 0 THEN '-' || g.grain ELSE '' END AS id,
       TIMESTAMP '2023-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(g.user_id % 100000 AS INT) AS t, 'log' AS s, 1.0 AS x,
       g.*, ranked.top_keys
FROM (SELECT user_id, event_id // 10000 AS grain, count(*) AS n, count(*) FILTER (event_id % 3 = 0) AS by_system,
             count(*) FILTER (event_id % 3 = 1) AS by_api, count(*) FILTER (event_id % 3 = 2) AS by_user,
             count(DISTINCT event_type) FILTER (event_id % 13 <> 0) AS n_keys,
             max(ts) FILTER (event_id % 17 <> 0) AS last_ts,
             first(CASE event_id % 3 WHEN 0 THEN 'SYSTEM' WHEN 1 THEN 'apikey01' ELSE 'user' END
                   ORDER BY CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END,
                            CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END DESC, ts, event_id) AS last_actor,
             first(CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END
                   ORDER BY CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END,
                            CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END DESC, ts, event_id) AS last_key
      FROM {{events}} GROUP BY user_id, event_id // 10000) g
LEFT JOIN (
  SELECT user_id, grain, string_agg(event_type, ', ' ORDER BY place) AS top_keys FROM (
    SELECT user_id, event_id // 10000 AS grain, event_type, row_number() OVER (PARTITION BY user_id, event_id // 10000 ORDER BY count(*) DESC, min(struct_pack(a := ts, b := event_id))) AS place
    FROM {{events}} WHERE event_id % 13 <> 0 GROUP BY user_id, event_id // 10000, event_type) WHERE place <= 3 GROUP BY user_id, grain) ranked
ON g.user_id = ranked.user_id AND g.grain = ranked.grain
"""


def _change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    grouped = events.groupBy("user_id", F.expr("event_id DIV 10000").alias("grain")).agg(
        F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("entries")
    )
    return grouped.selectExpr(
        "user_id AS k",
        f"concat({ENTITY_IDS}, user_id, if(grain > 0, concat('-', grain), '')) AS id",
        "TIMESTAMP '2023-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(user_id % 100000 AS INT) AS t",
        "'log' AS s",
        "1D AS x",
        "entries",
    )


_add(
    Sample(
        "changelogs",
        CHANGE_BASE,
        _change_rows,
        raw={
            "logs": (
                "to_json(transform(entries, e -> named_struct("
                "'key', if(e.event_id % 13 = 0, '', e.event_type), "
                "'updatedBy', CASE e.event_id % 3 WHEN 0 THEN 'SYSTEM' WHEN 1 THEN 'apikey01' ELSE 'user' END, "
                "'createdAt', if(e.event_id % 17 = 0, NULL, date_format(e.ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")))))"
            )
        },
        expect={
            "des_entity_type": (
                "CASE WHEN k % 9 < 7 THEN split_part(id, '_', 1) ELSE 'other' END"
            ),
            "val_total_changes": "n",
            "val_system_changes": "by_system",
            "val_api_changes": "by_api",
            "val_user_changes": "by_user",
            "ts_last_change": "last_ts",
            "des_last_change_actor": "last_actor",
            "txt_last_change_key": "last_key",
            "txt_top_changed_fields": "coalesce(top_keys, '')",
            "val_unique_fields_changed": "n_keys",
        },
    )
)

# --- back office --------------------------------------------------------------------------

_add(
    Sample(
        "geocontext",
        _simple("pages", "page_id", "geo_", "'page'", "0"),
        values={"fromIp": "CAST(16777216 + k * 256 AS STRING)", "toIp": "CAST(16777471 + k * 256 AS STRING)"},
    )
)
_add(Sample("invalid-phones", _simple("supplier", "s_suppkey", "+34", "s_name", "s_acctbal")))
_add(
    Sample(
        "sysusers",
        _simple("supplier", "s_suppkey", "sys_", "s_name", "s_acctbal"),
        values={"email": "'user' || CAST(k AS STRING) || '@example.org'"},
        raw={
            "roles": (
                "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '[\"admin\",\"\",0,\"agent\"]' ELSE '[\"agent\"]' END"
            ),
            "managesCountries": "if(k % 2 = 0, '[\"ES\",\"FR\"]', NULL)",
            "sales": "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '\"\"' WHEN 2 THEN '{\"isAvailable\":true}' ELSE '{\"isAvailable\":\"no\"}' END",
            "retentions": _presence("on", 2)[0],
        },
        expect={
            "txt_roles": "CASE k % 4 WHEN 1 THEN '' WHEN 2 THEN 'admin, agent' WHEN 3 THEN 'agent' END",
            "txt_manages_countries": "CASE WHEN k % 2 = 0 THEN 'ES, FR' END",
            "flg_is_sales_available": "CASE WHEN k % 4 > 1 THEN true END",
            "flg_has_sales_tracking": "CASE k % 4 WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN true END",
            "flg_has_retentions": _presence("", 2)[1],
        },
    )
)
_add(
    Sample(
        "stats",
        "SELECT k, CASE k % 4 WHEN 0 THEN 'SALES-STATS-a' WHEN 1 THEN 'PICKING-STATS-h' WHEN 2 THEN 'STATS-ES-' "
        "ELSE 'misc' END || CAST(k AS STRING) AS id, " + HOURS + " AS t, s, x "
        "FROM (SELECT CAST(p_partkey AS BIGINT) AS k, p_brand AS s, p_retailprice AS x FROM {part}) parts",
        values={"averageSales": "x"},
        expect={
            "des_stat_type": "CASE k % 4 WHEN 0 THEN 'sales' WHEN 1 THEN 'picking' WHEN 2 THEN 'business' ELSE 'unknown' END",
            "fk_agent_or_handler": "CASE k % 4 WHEN 0 THEN 'a' || k WHEN 1 THEN 'h' || k WHEN 2 THEN CAST(k AS VARCHAR) END",
        },
    )
)
_add(
    Sample(
        "sysinfo",
        "SELECT k, CASE k % 3 WHEN 0 THEN 'AVAILABLE-AGENTS-' ELSE 'CONFIG-' END || CAST(k AS STRING) AS id, "
        + HOURS + " AS t, s, x FROM (SELECT CAST(p_partkey AS BIGINT) AS k, p_brand AS s, p_retailprice AS x FROM {part}) parts",
        raw={
            "cron": _presence("daily", 0)[0],
            "transactionalEmails": _presence("on", 1)[0],
            "sales": _presence("on", 2)[0],
            "robots": _presence("on", 3)[0],
            "levels": (
                "CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN concat('{\"chicken\":{\"300\":', k, '},\"beef\":[{\"300\":\"7\"}]}') "
                "ELSE '{\"salmon\":{\"300\":[null,5]},\"turkey\":{\"100\":3}}' END"
            ),
        },
        expect={
            "flg_has_cron_settings": _presence("", 0)[1],
            "flg_has_email_settings": _presence("", 1)[1],
            "flg_has_sales_settings": _presence("", 2)[1],
            "flg_has_robot_settings": _presence("", 3)[1],
            "flg_has_stock_levels": "CASE WHEN k % 3 > 0 THEN true END",
            "flg_has_agent_lists": "k % 3 = 0",
            "val_chicken_stock": "CASE WHEN k % 3 = 1 THEN k END",
            "val_salmon_stock": "CASE WHEN k % 3 = 2 THEN 5 END",
            "val_beef_stock": "CASE WHEN k % 3 = 1 THEN 7 END",
            "val_turkey_stock": "NULL",
        },
    )
)


def transform_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        rows = collection_table(SAMPLES[name].messages(spark, sf_dir), name, as_of())
        return rounded(rows.drop(*CARRIED[1:]))

    run.__name__ = "transform_" + name.replace("-", "_")
    return run


QUERIES = {
    "transform_" + name.replace("-", "_"): (transform_query(name), sample.expected_sql())
    for name, sample in SAMPLES.items()
}
