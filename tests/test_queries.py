"""Every query with SQL against DuckDB on the smallest tables."""

import os
import re
from difflib import SequenceMatcher

import duckdb
import pandas as pd
import pytest

from tidewheel.functions import similarity
from tidewheel.plans import catalogue
from tidewheel.sources.adapter import trips

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def _plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6) + 0.0
        elif df[c].dtype.kind == "M":
            df[c] = df[c].astype("datetime64[us]")
    return sorted(map(tuple, df.astype(str).replace({"<NA>": "nan", "None": "nan"}).values))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query(spark, con, name):
    got, want = catalogue.QUERIES[name](spark, SF).toPandas(), con.execute(catalogue.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _plain(got) == _plain(want)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES.keys() - catalogue.ORACLE.keys()))
def test_query_without_sql_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).collect()


def _pairs_by_loops(pairs, partial, least):
    """The pairs that any of three scores calls alike, by plain loops."""
    words = lambda x: set(re.findall("[a-z0-9]+", x.lower()))
    out = {}
    for x, y in pairs:
        shared = len(words(x) & words(y)) / min(len(words(x)), len(words(y)))
        scores = (SequenceMatcher(None, x, y).ratio(), partial(x, y), shared)
        if any(s >= k for s, k in zip(scores, least, strict=True)):
            out[x, y] = tuple(round(s, 4) for s in scores)
    return out


def _best_window(a, b):
    s, t = sorted((a, b), key=len)
    return 1.0 if s in t else max(SequenceMatcher(None, s, t[i : i + len(s)]).ratio() for i in range(len(t) - len(s) + 1))


def test_fuzzy_pairs_against_loops(spark):
    got = catalogue.QUERIES["fuzzy_at_one_place"](spark, SF).collect()
    t = trips(spark, SF).selectExpr("start_station_name AS n", "round(start_station_latitude, 1) AS lat").distinct().collect()
    by = {}
    for r in t:
        by.setdefault(r.lat, set()).add(r.n.lower())
    pairs = [(k, x, y) for k, names in by.items() for x in names for y in names if x < y]
    want = _pairs_by_loops([(x, y) for _, x, y in pairs], _best_window, (0.80, 0.80, 0.85))
    assert {(r.name_a, r.name_b): (r.ratio_score, r.partial_ratio_score, r.token_overlap_score) for r in got} == want and want


def test_similar_pairs_against_loops(spark):
    got = catalogue.QUERIES["similarity_pairs"](spark, SF).collect()
    blocked = [(r.a, r.b) for r in catalogue.QUERIES["blocking_pairs"](spark, SF).collect()]  # itself held against SQL
    want = _pairs_by_loops(blocked, similarity.partial_fast_of, (0.80, 0.85, 0.80))
    assert {(r.left_normalized_name, r.right_normalized_name): (r.ratio_score, r.partial_ratio_score, r.token_overlap_score) for r in got} == want and want
    n = catalogue.QUERIES["similarity_buckets"](spark, SF).first()
    assert (n.near, n.middle, n.far) == (sum(r.distance_km <= 0.2 for r in got), sum(0.2 < r.distance_km <= 1 for r in got), sum(r.distance_km > 1 for r in got))


def test_entry_point(spark):
    import __spark_entry__ as e

    assert catalogue.QUERIES.keys() <= e.queries().keys() and e.oracle_sql().keys() <= e.queries().keys()
    assert e.entry(spark).count() > 0
