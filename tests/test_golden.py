"""Hand-written documents for every decision about polymorphic, absent and damaged values."""

import datetime as dt
import json

from feedloom.functions.arrays import STAGES
from feedloom.functions.variant import Node
from helpers import table

D = dt.datetime


def test_scalar_field_holding_a_list(spark):
    one, two, three = table(
        spark, "customers", {"_id": "a", "email": ["", None, "a@x"]}, {"_id": "b", "email": ""}, {"_id": "c", "email": []}
    )
    assert (one["des_email"], two["des_email"], three["des_email"]) == ("a@x", None, None)


def test_text_that_looks_like_json_stays_text(spark):
    rows = table(spark, "customers", {"_id": "a", "email": "[1,2]"}, {"_id": "b", "email": '{"$oid":"x"}'}, {"_id": "c", "email": {"$oid": "ab"}})
    assert [r["des_email"] for r in rows] == ["[1,2]", '{"$oid":"x"}', "ab"]


def test_arrays_absent_null_empty_and_full(spark):
    rows = table(
        spark,
        "customers",
        {"_id": "a"},
        {"_id": "b", "dogs": None},
        {"_id": "c", "dogs": {}},
        {"_id": "d", "dogs": []},
        {"_id": "e", "dogs": [{"name": "Rex", "weight": 3}, {"name": ["", "Bo"], "weight": "2.5"}, 7]},
        {"_id": "f", "dogs": "none"},
    )
    got = [(r["val_dogs_count"], r["txt_dog_names"], r["val_total_dog_weight"]) for r in rows]
    assert got == [
        (None, None, None), (None, None, None), (None, None, None), (0, "", None), (3, "Rex, Bo", 5.5), (0, "", None),
    ]


def test_document_measures_run_without_their_field(spark):
    (row,) = table(spark, "customers", {"_id": "a"})
    assert row["val_active_orders_count"] == 0
    (row,) = table(spark, "engagement-histories", {"_id": "a"})
    assert row["flg_has_daily_grams_recommendations"] is False


def test_dates(spark):
    values = ["2024-01-01T00:00:00Z", {"$date": "2024-01-01T00:00:00Z"}, {"$date": {"$numberLong": "1704067200000"}},
              ["", "2024-01-01"], "2024-13-01", "10:30", "2024", 5, "2024-01-01T02:00:00.5+02:00"]
    rows = table(spark, "coupons", *[{"_id": str(i), "createdAt": v} for i, v in enumerate(values)])
    new_year = D(2024, 1, 1)
    assert [r["ts_coupon_created_at"] for r in rows] == [
        new_year, new_year, new_year, new_year, None, None, None, None, D(2024, 1, 1, 0, 0, 0, 500000),
    ]


def test_whole_numbers(spark):
    values = ["7", " 7 ", "1.9", 1.9, -1.9, True, "true", {"$numberLong": "9"}, ["", 4], "x", [], 1e30]
    rows = table(spark, "customers", *[{"_id": str(i), "legacyId": v} for i, v in enumerate(values)])
    assert [r["val_legacy_id"] for r in rows] == [7, 7, None, 1, -1, 1, None, 9, 4, None, None, None]


def test_real_numbers(spark):
    values = ["1.5", 2, {"$numberDouble": "2.5"}, {"$numberDecimal": "3.25"}, "x", [None, 4.5], True]
    rows = table(spark, "leads", *[{"_id": str(i), "trialAmount": v} for i, v in enumerate(values)])
    assert [r["imp_trial_amount"] for r in rows] == [1.5, 2.0, 2.5, 3.25, None, 4.5, 1.0]


def test_truthiness(spark):
    values = ["false", False, 0, 1, "0", True, "", None, {"a": 1}, ["", 0], "true"]
    rows = table(spark, "leads", *[{"_id": str(i), "isAnonymous": v} for i, v in enumerate(values)])
    assert [r["flg_anonymous"] for r in rows] == [True, False, False, True, True, True, None, None, True, False, True]


def test_other_types_in_text_fields(spark):
    (row,) = table(spark, "customers", {"_id": {"$oid": "ab12"}, "address": [{"zip": 28001}, {"zip": 1}]})
    assert (row["pk_client"], row["cod_zip"]) == ("ab12", "28001")


def test_latest_refund_ties_go_to_the_first(spark):
    refunds = [
        {"createdAt": "2024-01-01", "status": "old", "amount": 1},
        {"createdAt": {"$date": "2024-02-01T00:00:00Z"}, "status": "first", "amount": "2.5", "reason": {"category": "late"}},
        {"createdAt": "2024-02-01", "status": "second", "reason": {"category": "other"}},
        {"status": "untimed", "amount": "bad"},
    ]
    (row,) = table(spark, "payments", {"_id": "p", "refunds": refunds})
    assert row["des_latest_refund_status"] == "first"
    assert row["des_latest_refund_reason"] == "late"
    assert (row["val_refunds_count"], row["imp_total_refund_amount"]) == (4, 3.5)


def test_lists_in_refunds_are_read_from_their_texts(spark):
    class TextOnly(Node):
        def raw(self, as_type="variant", *below):
            if "variant" in as_type:
                return f"CAST(raise_error('read as VARIANT') AS {as_type})"
            return super().raw(as_type, *below)

    refunds = [
        {"amount": ["", "2.5"], "createdAt": {"$date": "2024-02-01T00:00:00Z"}, "status": ["", None, "done"], "reason": {"category": "late"}},
        {"amount": [], "createdAt": ["2024-02-02"], "status": [""]},
    ]
    node, stage = TextOnly("document", "refunds"), STAGES["refunds"]
    rows = spark.createDataFrame([(json.dumps({"refunds": refunds}),)], "text string").selectExpr("parse_json(text) AS document")
    staged = rows.selectExpr("document", f"{stage.texts(node)} AS texts")
    one, two = staged.selectExpr(f"{stage.typed(node, 'texts')} AS refunds").first()["refunds"]
    assert one.asDict() == {"amount": 2.5, "createdAt": D(2024, 2, 1), "status": "done", "reason": '{"category":"late"}'}
    assert two.asDict() == {"amount": None, "createdAt": D(2024, 2, 2), "status": None, "reason": None}


def test_lists_in_refunds_that_text_does_not_decide(spark):
    refunds = [
        {"createdAt": "2024-01-01", "status": "[1,2]", "amount": [{"$numberLong": "4"}]},
        {"createdAt": ["2024-03-01"], "status": [{"$oid": "ab"}], "amount": "x"},
    ]
    (row,) = table(spark, "payments", {"_id": "p", "refunds": refunds})
    assert (row["des_latest_refund_status"], row["imp_total_refund_amount"]) == ("ab", 4.0)
    (row,) = table(spark, "payments", {"_id": "p", "refunds": refunds[:1]})
    assert row["des_latest_refund_status"] == "[1,2]"


def test_refund_category(spark):
    reasons = [{"category": "late"}, {"category": 'la"t\\e\n'}, {"category": ["", "x"]}, {"category": "a", "more": 1}, [None, {"category": "y"}],
               '{"category":"z"}', '{"category":"z"', {"category": ""}, {"category": {"$oid": "ab"}}, "late", None]
    rows = table(spark, "payments", *[{"_id": "p", "refunds": [{"createdAt": "2024-01-01", "reason": r}]} for r in reasons])
    assert [r["des_latest_refund_reason"] for r in rows] == ["late", 'la"t\\e\n', "x", "a", "y", "z", None, None, "ab", None, None]


def test_line_items(spark):
    items = [{"qty": 2, "unitGrams": 10, "unitAmount": 1.5, "product": "P"}, {"qty": ["", "3"], "unitAmount": "2"}, {"qty": "x"}, "junk"]
    (row,) = table(spark, "payments", {"_id": "p", "lineItems": items, "orders": ["o1", "", {"$oid": "o2"}, 0]})
    assert (row["val_line_items_count"], row["val_total_product_qty"], row["val_total_product_grams"]) == (4, 5, 20)
    assert (row["imp_line_items_total_amount"], row["txt_products_list"]) == (9.0, "P")
    assert (row["val_linked_orders_count"], row["txt_linked_order_ids"]) == (4, "o1, o2")


def test_change_log_measures(spark):
    logs = [
        {"key": "a", "updatedBy": "SYSTEM", "createdAt": "2024-01-01"},
        {"key": "b", "updatedBy": "u", "createdAt": "2024-01-02"},
        {"key": "b", "updatedBy": "apikey01", "createdAt": "2024-01-02"},
        {"key": "c"}, {"key": "d"}, {"key": "d"},
    ]
    row, untimed = table(spark, "changelogs", {"_id": "ord_1", "logs": logs}, {"_id": 12, "logs": [{"key": "x", "updatedBy": "u"}, {"key": "y"}]})
    assert (row["val_total_changes"], row["val_system_changes"], row["val_api_changes"], row["val_user_changes"]) == (6, 1, 1, 4)
    assert (row["ts_last_change"], row["des_last_change_actor"], row["txt_last_change_key"]) == (D(2024, 1, 2), "u", "b")
    assert (row["txt_top_changed_fields"], row["val_unique_fields_changed"]) == ("b, d, a", 4)
    assert (row["des_entity_type"], untimed["des_entity_type"]) == ("ord", "unknown")
    assert (untimed["ts_last_change"], untimed["des_last_change_actor"], untimed["txt_last_change_key"]) == (None, "u", "x")


def test_bags(spark):
    full = {"bagList": {"100": {"beef": 2, "chicken": "3"}, "300": {"beef": [None, 1]}, "400": "none"}}
    rows = table(spark, "orders", {"_id": "a", "content": full}, {"_id": "b", "content": {"extras": [1]}}, {"_id": "c"}, {"_id": "d", "content": "x"})
    keys = ("val_total_bags", "val_beef_bags", "val_bag_size_100_count", "val_bag_size_500_count")
    assert [tuple(r[k] for k in keys) for r in rows] == [(6, 3, 5, 0), (0, 0, 0, 0), (None,) * 4, (0, 0, 0, 0)]


def test_presence_flags(spark):
    values = [None, "", {}, {"a": 1}, ["", None], ["x"], 0]
    rows = table(spark, "leads-archive", *[{"_id": str(i), "sharedInfo": v} for i, v in enumerate(values)], {"_id": "z"})
    assert [r["flg_has_shared_info"] for r in rows] == [None, False, None, True, False, True, True, None]


def test_stat_ids(spark):
    rows = table(spark, "stats", *[{"_id": i} for i in ("SALES-STATS-ann-1", "PICKING-STATS-bob", "X-STATS", "misc", 5)])
    assert [(r["des_stat_type"], r["fk_agent_or_handler"]) for r in rows] == [
        ("sales", "ann"), ("picking", "bob"), ("business", None), ("unknown", None), ("unknown", None),
    ]


def test_label_lengths(spark):
    rows = table(spark, "deliveries", {"_id": "a", "labelData": "héé"}, {"_id": "b", "labelData": ""}, {"_id": "c"})
    assert [(r["flg_has_label_data"], r["val_label_data_length"]) for r in rows] == [(True, 3), (False, 0), (None, None)]


def test_redaction_hides_secrets(spark):
    from helpers import envelope, messages

    from feedloom.plans.ingest import route_messages, transform_collection

    routed = route_messages(messages(spark, [envelope("users-metadata", {"_id": "u", "password": "h", "verificationToken": "t"})]))
    plain = transform_collection(routed, "users-metadata").first()
    hidden = transform_collection(routed, "users-metadata", redact=True).first()
    assert (plain["txt_password_hash"], plain["cod_verification_token"]) == ("h", "t")
    assert len(hidden["txt_password_hash"]) == 64 and len(hidden["cod_verification_token"]) == 64


def test_lists_that_their_text_decides_are_not_read_by_type(spark, monkeypatch):
    monkeypatch.setattr(Node, "careful", lambda self, as_type: f"CAST(raise_error('read by type') AS {as_type})")
    values = [["", None, False], ["false"], [True, False], "x", ["", "true"]]
    rows = table(spark, "leads", *[{"_id": str(i), "isAnonymous": v} for i, v in enumerate(values)])
    assert [r["flg_anonymous"] for r in rows] == [False, True, True, True, True]
    (row,) = table(spark, "customers", {"_id": ["", "a"], "email": [None, "a@x", "b@x"], "legacyId": ["", 7]})
    assert (row["pk_client"], row["des_email"], row["val_legacy_id"]) == ("a", "a@x", 7)
    rows = table(spark, "coupons", {"_id": "a", "createdAt": ["", "2024-01-01"]}, {"_id": "b", "createdAt": [{"$date": "2024-01-01T00:00:00Z"}]})
    assert [r["ts_coupon_created_at"] for r in rows] == [D(2024, 1, 1)] * 2


def test_lists_that_their_text_does_not_decide(spark):
    values = [[False], [0], ["0"], ["", 2], [[]], [{}], "[x", ["", None], [], [{"a": 1}], ["x", False], [False, "x"], ["", "false", False]]
    rows = table(spark, "leads", *[{"_id": str(i), "isAnonymous": v} for i, v in enumerate(values)])
    assert [r["flg_anonymous"] for r in rows] == [False, False, True, True, False, False, True, None, None, True, True, False, True]
    values = [[{"$numberLong": "9"}], ["x", 4], [1.9], ["1.9"], [True], [[5]], ["[5]"], "[5]", [None]]
    rows = table(spark, "customers", *[{"_id": str(i), "legacyId": v, "email": v} for i, v in enumerate(values)])
    assert [r["val_legacy_id"] for r in rows] == [9, None, 1, None, 1, None, None, None, None]
    assert [r["des_email"] for r in rows] == ['{"$numberLong":"9"}', "x", "1.9", "1.9", "true", "[5]", "[5]", "[5]", None]


def test_bag_counts_in_lists_are_read_from_their_texts(spark, monkeypatch):
    full = {"100": {"beef": 2, "chicken": [None, "3"]}, "300": {"beef": ["", 1, 5]}}
    other = {"100": {"beef": [{"$numberLong": "2"}], "chicken": 1.9}, "300": {"beef": ["x", 5]}}
    names = ("val_total_bags", "val_beef_bags", "val_bag_size_100_count")
    (row,) = table(spark, "orders", {"_id": "b", "content": {"bagList": other}})
    assert [row[n] for n in names] == [3, 2, 3]
    from feedloom.functions import variant

    monkeypatch.setattr(variant, "integer_of", lambda value: "CAST(raise_error('read by type') AS bigint)")
    (row,) = table(spark, "orders", {"_id": "a", "content": {"bagList": full}})
    assert [row[n] for n in names] == [6, 3, 5]


def test_objects_are_counted_and_not_printed_to_tell_that_they_are_there(spark):
    assert "map<string,binary>" in Node("document", "package").present()
    values = [None, {}, {"a": {}}, {"handlers": [1, 2]}, [], "", "{}", 0, False]
    rows = table(spark, "orders", *[{"_id": str(i), "package": v} for i, v in enumerate(values)], {"_id": "z"})
    assert [r["val_package_handlers_count"] for r in rows] == [None, None, 0, 2, 0, 0, 0, 0, 0, None]
