"""The registry against the blueprint's own tables."""

import os
import re

import pytest

from feedloom.operators.mapping import Collection, camel_case
from feedloom.plans.collections import REGISTRY

BLUEPRINT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "FIXTURES.md")
TYPES = {"string": "string", "timestamp": "timestamp", "float64": "double", "int64": "bigint", "bool": "boolean"}
SIZES = {
    "customers": (50, 65), "leads": (43, 48), "orders": (61, 60), "payments": (50, 47), "deliveries": (30, 30),
    "coupons": (10, 9), "users-metadata": (12, 11), "leads-archive": (53, 45), "contacts-logs": (17, 18),
    "retentions": (23, 23), "notifications": (14, 13), "appointments": (10, 10), "changelogs": (17, 17),
    "orders-archive": (46, 46), "payments-archive": (37, 37), "packages": (12, 12), "engagement-histories": (10, 10),
    "geocontext": (7, 7), "invalid-phones": (8, 8), "sysusers": (18, 18), "stats": (21, 21), "sysinfo": (16, 16),
}


def test_sizes():
    assert {n: (len(c.target_columns), len(c.mapped) + 3) for n, c in REGISTRY.items()} == SIZES


def _sections():
    text = open(BLUEPRINT).read().split("## 5.")[1]
    for part in re.split(r"\n### ", text)[1:]:
        rows = [
            [cell.strip() for cell in line.split("|")[1:-1]]
            for line in part.splitlines()
            if line.startswith("| ") and not line.startswith(("| target", "| ---"))
        ]
        yield part.splitlines()[0].strip(), rows


@pytest.mark.skipif(not os.path.exists(BLUEPRINT), reason="blueprint not present")
def test_fields_match_blueprint():
    seen = set()
    for name, rows in _sections():
        collection = REGISTRY[name]
        fields = {f.target: f for f in collection.fields + collection.dropped}
        kept = [r[0] for r in rows if r[1] != "*dropped*"]
        assert kept == [f.target for f in collection.fields], name
        for target, kind, source, *_ in rows:
            field = fields[target]
            if kind != "*dropped*":
                assert TYPES[kind] == field.as_type, (name, target)
            path = source.strip("`")
            if path == "—":
                assert field.source is None
            elif path != "document":
                assert path == field.source, (name, target)
        assert {r[0] for r in rows} == set(fields), name
        seen.add(name)
    assert seen == set(REGISTRY)


def test_source_follows_target_name():
    c = Collection.parse("x", "pk_x _id\nflg_is_trial\nval_weight:double a.b count\nts_gone -\ndropped\ncod_y\n")
    assert camel_case("is_trial") == "isTrial"
    assert [(f.target, f.as_type, f.source, f.function) for f in c.fields] == [
        ("pk_x", "string", "_id", None),
        ("flg_is_trial", "boolean", "isTrial", None),
        ("val_weight", "double", "a.b", "count"),
        ("ts_gone", "timestamp", None, None),
    ]
    assert [f.target for f in c.dropped] == ["cod_y"]
    assert [n for n, _ in c.target_columns][:3] == ["pk_x", "pk_yearmonth", "des_data_origin"]
