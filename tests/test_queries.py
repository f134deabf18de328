"""Core queries against their SQL, where the test data is there."""

import math
import os

import pytest

import __spark_entry__ as entry
from sarqyt.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def table(df):
    df = df.astype(object).where(df.notna(), None)
    return sorted(df.columns), sorted(str([plain(r[c]) for c in sorted(df.columns)]) for r in df.to_dict("records"))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    import duckdb

    got = registry.queries()[name](spark, DATA)
    if name not in registry.oracle_sql():
        assert got.count() > 0
        return
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    want = con.execute(registry.oracle_sql()[name]).df()
    a, b = table(got.toPandas()), table(want)
    assert a[0] == b[0] and len(a[1]) == len(b[1]) and a[1] == b[1]


def test_operators_change_something(spark):
    """The artefacts put into the texts are acted on, so the comparisons above are not of two idle operators."""
    q = registry.queries()
    raw = spark.read.parquet(f"{DATA}/aligned_corpus.parquet")
    for name in ("noise_line_removal", "hyphen_repair", "spacing_repair", "case_repair", "ocr_repair_v1"):
        seen = q[name](spark, DATA).join(raw.select("row_id", registry._noisy().alias("t")), "row_id")
        assert seen.where("text <> t").count() > 20, name
    for name in ("triplet_reason", "basic_filter_v1"):
        assert q[name](spark, DATA).select("reason").distinct().count() > 1, name


def test_entry(spark):
    assert entry.entry(spark).count() > 0
