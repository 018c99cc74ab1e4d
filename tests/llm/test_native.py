"""URL rules and exact top-k search, against plain Python."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm import kdtree, urls
from roadlake.llm.queries import ORACLES, QUERIES
from tests.conftest import plan, values

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    theirs = duck.sql(ORACLES[name]).select(*[f'"{c}"' for c in columns]).fetchall()
    assert sorted(map(str, values(found, *columns))) == sorted(map(str, theirs)) and theirs


def test_hosts_paths_and_rules(frame):
    rows = [
        "http://A.Example.ORG/es/x?y#z", "https://example.org/en/12", "https://notexample.org/es/", "http://x.com/de", "http://x.com/de/",
        "http://x.com?u=://y.org/es/", "http://com/fr/a", "ftp://m.ads-track.example.net/x", "http://x.net/ads-track", "no url", "", None, "://",
        "http://cheap-pills.net", "http://x.net/login?a=1", "http://org#f",
    ]
    found = urls.judge(frame("url string, verdict int", *((r, 0) for r in rows)))
    assert values(found, "host", "path", "rule", "verdict") == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("notexample.org", "/es/", "org/", "allow"), ("x.com", "/de", None, "allow"), ("x.com", "/de/", "com/de/", "block"),
        ("x.com", "", None, "allow"), ("com", "/fr/a", "com/fr/", "allow"), ("m.ads-track.example.net", "/x", None, "block"),
        ("x.net", "/ads-track", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("cheap-pills.net", "", None, "block"), ("x.net", "/login", None, "block"), ("org", "", None, "allow"),
    ]
    assert "Python" not in plan(found) and "Arrow" not in plan(found)


def test_rules_are_filed_under_their_rarest_token(frame):
    df = frame("url string", "http://cheap.net", "http://cheap.org", "http://pills.net")
    index = urls.rarest(df, "url", ((r"cheap-pills", ("cheap", "pills")), ("never", ("zzz",))))
    assert index == {"pills": ["cheap-pills"], "zzz": ["never"]}
    assert values(urls.judge(df, addresses=(), patterns=()), "verdict") == [("allow",)] * 3
    assert values(urls.judge(frame("url string")), "verdict") == []


def brute(rows, queries, k):
    out = []
    for name, vector in sorted(queries):
        scores = sorted((-int(np.dot(vector, v)), i) for i, v in rows if i != name and len(v) == len(vector))
        out += [(name, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return out


@pytest.mark.parametrize("seed, span, shard", [(1, 3, 40), (2, 1000, 40), (3, 1, 10_000)])
def test_top_k_with_ties_and_equal_vectors(frame, monkeypatch, seed, span, shard):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", shard)
    monkeypatch.setattr(kdtree, "LEAF_ROWS", 8)
    rng = np.random.RandomState(seed)
    rows = [(i, rng.randint(-span, span + 1, 5).tolist()) for i in range(150)] + [(i, [1, 1, 1, 1, 1]) for i in range(150, 200)]
    rows += [(300, [1, 2]), (301, [3, 4]), (320, []), (321, [])]
    df = frame("vec_id long, vector array<long>", *rows)
    queries = [r for r in rows if r[0] % 20 == 0]
    found = kdtree.top_k(df, df.filter("vec_id % 20 = 0"), 6)
    assert sorted(values(found, "query_id", "rank", "vec_id", "score")) == brute(rows, queries, 6)


def test_odd_vectors(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.01]), (0, [0.5, -0.01]), (1, None), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]), (5, [1.0, 1.0]), (5, [1.0, 1.0])]
    df = frame("vec_id long, embedding array<float>", *rows).select("vec_id", kdtree.whole(F.col("embedding")).alias("vector"))
    # the repeated query is one query; the repeated candidate counts twice; the query's own id does not
    found = kdtree.top_k(df, df.filter("vec_id = 0"))
    assert sorted(values(found, "query_id", "rank", "vec_id", "score")) == [(0, 1, 5, 32 * 64 - 64), (0, 2, 5, 32 * 64 - 64)]
    empty = df.filter("false")
    assert values(kdtree.top_k(empty, empty)) == []


def test_scores_beyond_doubles(frame):
    rows = [(0, [3_037_000_499, 1]), (1, [3_037_000_499, 5]), (2, [3_037_000_499, 6])]
    df = frame("vec_id long, vector array<long>", *rows)
    assert sorted(values(kdtree.top_k(df, df.filter("vec_id = 0")), "rank", "vec_id", "score")) == [
        (1, 2, 3_037_000_499**2 + 6), (2, 1, 3_037_000_499**2 + 5)]
