"""Every registered query with a SQL twin equals DuckDB's answer (sf0.001)."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck
from tillpanel.oracles import ORACLES
from tillpanel.queries import QUERIES

NAMES = [n for n in QUERIES if n in ORACLES]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["exact"], r


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 1
    assert set(E.oracle_sql()) <= set(E.queries())
