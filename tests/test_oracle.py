"""Every registered query equals its DuckDB oracle SQL on the sf0.001 data."""

import pytest

import __spark_entry__ as E
from registrar_feeds.oracle import oracle_queries
from registrar_feeds.plans.registry import registry
from tests.conftest import SMOKE_DIR
from tools.check_oracle import compare

KEYS = sorted(E.oracle_sql())


def test_every_query_has_oracle_sql():
    own = {k for k in E.queries() if k in registry()}
    assert own == set(registry()) and own == set(oracle_queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["mtg_no", "crls_code", "targ_code"]
    assert df.count() == 773


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    res = compare(spark, SMOKE_DIR, [key], verbose=False)[key]
    assert res["cols_ok"], key
    assert res["rows"] == res["oracle_rows"], key
    assert res["match"], key
