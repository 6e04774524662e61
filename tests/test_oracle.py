"""Every registered data product equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from opticart import oracle, registry
from tests.conftest import SMALL
from tests.helpers import same_result

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) == 27     # D01-D22, the streaming form of D22, four kept in place
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    same_result(QUERIES[name](spark, SMALL), duck, SQL[name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["name", "amount"]
    assert 0 < df.count() <= 10
