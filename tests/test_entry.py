"""Driver contract: entry/queries/oracle_sql, and a quick oracle subset."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
QUICK = ["a1_trip_frequency", "g5_neighbor_distance", "f14_clean_metered_trips", "a15_boundary_stats",
         "k9_connected_zone_lists"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"route", "coverage_count", "coverage_percentage", "trip_path"}


def test_every_query_has_a_twin():
    from routecov.plans.oracle import NO_TWIN
    from routecov.plans.queries import QUERIES
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) & set(QUERIES) == set(QUERIES) - NO_TWIN


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", QUICK if not os.environ.get("ROUTECOV_ORACLE_ALL") else sorted(E.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    cols = sorted(df.columns)
    assert cols == sorted(dcols)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    want = sorted(tuple(_norm(r[dcols.index(c)]) for c in cols) for r in res.fetchall())
    assert got == want
