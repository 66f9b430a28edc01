"""Every catalog key against its DuckDB oracle (or rows-only) on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from cohortix.plans import catalog  # noqa: E402
from check_oracle import compare  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

KEYS = sorted(catalog.queries())


def test_every_key_has_oracle_or_is_documented():
    missing = set(catalog.queries()) - set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())
    assert missing == set(), f"keys without oracle SQL: {missing}"


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    msg, ok = compare(spark, duck, key, E.queries()[key], E.oracle_sql().get(key), SF_SMALL)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "time_period" in df.columns
    assert df.count() >= 0
