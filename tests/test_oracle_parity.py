"""Every registered query with a DuckDB twin must match it at sf0.01."""

import pytest

from tests.conftest import SF01
from tests.oracle import compare

import __spark_entry__ as E

from storelens.plans.registry import registry

# the training-data queries have tests of their own
_Q = {n: E.queries()[n] for n in registry()}
_SQL = {n: s for n, s in E.oracle_sql().items() if n in _Q}


@pytest.mark.parametrize("name", sorted(_SQL))
def test_matches_oracle(spark, duck01, name):
    df = _Q[name](spark, SF01)
    n = compare(df, duck01, _SQL[name])
    assert n > 0


@pytest.mark.parametrize("name", sorted(set(_Q) - set(_SQL)))
def test_rows_only(spark, name):
    df = _Q[name](spark, SF01)
    assert df.count() > 0
    assert df.columns


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert df.columns[:4] == ["store_id", "store_name", "city", "item_id"]
