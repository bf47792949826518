"""Every registered query against its DuckDB oracle (row count, columns, values) at sf0.001,
the way the driver checks sf0.01; queries without an oracle must at least run."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["title", "total_files", "moved_files", "folder"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    if key not in ORACLES:
        return
    res = con.execute(ORACLES[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)
