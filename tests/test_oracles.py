"""Every registered query against its DuckDB oracle on the smallest data set."""

import pytest

from given import SF_SMALL

import __spark_entry__ as entry
from tools.oracle_check import _rows, duck

ORACLES = entry.oracle_sql()
ROWS_ONLY = sorted(set(entry.queries()) - set(ORACLES))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLES[key])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _rows(cols, res.fetchall())


def test_every_key_is_registered():
    assert len(entry.queries()) >= 65
    assert len(ORACLES) >= 50


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and set(df.columns) >= {"symbol", "mt", "n"}
