"""Every ledger query against its DuckDB oracle on the smallest tables (the driver
runs the same comparison at sf0.01); tests/llm does it for the training-data queries."""
import duckdb
import pytest

import __spark_entry__ as E
from blockhouse.plans.oracles import SQL
from blockhouse.plans.queries import Q
from scripts.compare import TABLES, digest

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(Q) == set(SQL) and set(Q) <= set(E.queries())
    assert len(Q) >= 85


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "day", "hour", "n_rows"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(Q))
def test_query_matches_oracle(spark, con, key):
    df = Q[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    h1, l1 = digest(df.columns, rows)
    h2, l2 = digest(ocols, orows)
    assert h1 == h2, (sorted(set(l1) - set(l2))[:3], sorted(set(l2) - set(l1))[:3])
