"""Training-data queries against their DuckDB statements on the smallest tables."""
import duckdb
import pytest

from blockhouse.llm.oracles import SQL
from blockhouse.llm.queries import Q
from scripts.compare import TABLES, digest
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_statements_belong_to_queries():
    assert set(SQL) <= set(Q)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    df = Q[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols) and len(rows) == len(orows)
    h1, l1 = digest(df.columns, rows)
    h2, l2 = digest(ocols, orows)
    assert h1 == h2, (sorted(set(l1) - set(l2))[:3], sorted(set(l2) - set(l1))[:3])
