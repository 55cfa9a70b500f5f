"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF01

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as E  # noqa: E402
from oracle_check import frame_hash  # noqa: E402
from tabspark.sources.tables import TABLES  # noqa: E402

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert rows, f"{name} returned no rows"
        return
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert frame_hash(df.columns, rows)[0] == frame_hash(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns[0] == "feature"
