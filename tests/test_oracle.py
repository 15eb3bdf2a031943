"""Every registered query against its DuckDB SQL (the driver's check)."""

import pytest

import __spark_entry__ as entry
from visitlens import registry
from conftest import SF_SMALL
from oracle_compare import compare, duck

NAMES = list(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF_SMALL, con)
    assert res["match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["area", "area_level", "pid", "city_infos", "click_count", "product_name",
                          "product_status"]
    assert df.count() > 0
