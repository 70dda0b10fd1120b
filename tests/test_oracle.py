"""Every registered query against its SQL twin (DuckDB) on the small tables."""

import pytest

import __spark_entry__ as E
from basketry.plans.registry import QUERIES
from check import compare
from conftest import SF_SMALL

KEYS = sorted(QUERIES)


def test_every_key_has_a_sql_twin_or_is_documented():
    rows_only = set(KEYS) - set(E.oracle_sql())
    assert rows_only == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["session_id", "total", "item_count", "scan_count"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, key):
    res = compare(spark, SF_SMALL, [key], verbose=False)[key]
    assert res[0] in ("match", "rows-only"), res
