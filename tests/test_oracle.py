"""Every trip-model query against its DuckDB oracle on sf0.001 (driver-style check)."""

import pytest

import __spark_entry__ as E
from meterline.plans.catalog import QUERIES
from tests.conftest import SF001
from tests.oracle_harness import compare, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF001, con)
    assert r["status"] == "ok", r
    assert not r.get("types"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["pickup_location_id", "zone_name", "prev_pickup_datetime",
                          "pickup_datetime", "gap_minutes", "gap_rank"]
    assert df.count() >= 0
