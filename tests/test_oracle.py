"""Every catalog key against its DuckDB oracle on the smallest test tables
(the driver runs the same check at sf0.01)."""

import pytest

import __spark_entry__ as E
from oracle_util import duck, rows_of_duck, rows_of_spark, sort_key

KEYS = sorted(E.queries())
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_dir, con, key):
    df = E.queries()[key](spark, sf_dir)
    scols, srows = rows_of_spark(df)
    if key not in ORACLE:
        assert srows is not None
        return
    dcols, drows = rows_of_duck(con, ORACLE[key])
    assert scols == dcols
    assert len(srows) == len(drows)
    assert sorted(srows, key=sort_key) == sorted(drows, key=sort_key)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "variable_name" in df.columns
