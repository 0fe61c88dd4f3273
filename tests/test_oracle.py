"""Every registered query against its SQL oracle (DuckDB) on sf0.001, and
every rows-only query runs."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import _rows, duck  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()
FAST_ROWS_ONLY = [q for q in QUERIES if q not in ORACLES]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


@pytest.mark.parametrize("name", FAST_ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0 and df.columns


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 2
