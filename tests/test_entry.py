import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from crawlmeta.plans.queries import QUERIES
from tests.conftest import SF0001

TABLES = ["pages", "lineitem", "documents", "nation", "orders"]
SLOW = {"crawl_links", "crawl_counters", "warc_roundtrip", "stream_equals_batch"}


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"country_key", "language_region", "links"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_mod.queries()) and set(QUERIES) <= set(entry_mod.oracle_sql())


def _norm(v):
    if v is None:
        return "\x00NULL"
    if isinstance(v, float):
        return repr(round(v, 6)) if not math.isnan(v) else "nan"
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF0001}/{t}.parquet')")
    df = entry_mod.queries()[name](spark, SF0001)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(entry_mod.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    exp = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == exp
