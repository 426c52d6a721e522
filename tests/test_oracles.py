"""Every registered query agrees with its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from small_inputs import SMALL_SF
from oracle_check import compare
from quarry import catalog

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLES)
    assert not rows_only
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, QUERIES[name], ORACLES[name], SMALL_SF, verbose=True)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema] == ["source", "language", "split", "n"]
    assert df.count() > 0
