"""Queries of the subpackage against their SQL, on the smallest tables, and what the planted traces give away there."""

import os

import pytest

from sarqyt.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    want = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in want.description]
    rows = sorted(map(str, want.fetchall()))
    got = queries.queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert sorted(str(tuple(r[c] for c in names)) for r in got.collect()) == rows


@pytest.mark.parametrize("name", sorted(n for n in queries.queries() if n.endswith("_found")))
def test_no_row_twice_and_fixed_columns(spark, name):
    got = queries.queries()[name](spark, DATA)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    kinds = dict(got.dtypes)
    assert all(k == ("string" if c == "field" else "int" if c == "end_pos" else "bigint") for c, k in kinds.items())
