"""Every query of the candle pipeline against its DuckDB oracle on the smallest
tables (the driver runs the same comparison at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from barsmith.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
TABLES = "region nation customer supplier part orders lineitem events".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["ts", "datetime", "underlying"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    got = sorted((tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in sorted(cols)]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want


TIME_QUERIES = ["epoch_to_iso", "option_enrich", "watermark", "upsert_dataset", "request_grid",
                "split_precedence", "coverage_gaps", "cast_and_fill", "legacy_layout_scan"]


@pytest.mark.parametrize("name", TIME_QUERIES)
def test_time_queries_ignore_session_time_zone(spark, con, name):
    """The driver's session may use any time zone; results must not move."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_oracle(spark, con, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
