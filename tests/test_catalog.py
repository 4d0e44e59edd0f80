"""Every registered query against its DuckDB equivalent on the driver tables."""

import pytest

import __spark_entry__ as contract
from feedloom.catalog import documents, drift, intake, telemetry
from feedloom.catalog.compare import differences

OWN = {**documents.QUERIES, **intake.QUERIES, **drift.QUERIES, **telemetry.QUERIES}
QUERIES = {name: run for name, run in contract.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in OWN}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) == set(OWN)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    pytest.importorskip("duckdb")
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir) == []


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "val_line_items_count" in df.columns
