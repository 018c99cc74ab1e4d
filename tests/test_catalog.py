"""Every named query against its SQL counterpart on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from roadlake.plans.catalog import QUERIES
from tests.conftest import plan

FOLDER = "/root/testdata/sf0.001"
TABLES = ("lineitem", "orders", "events", "documents", "labels")
ORACLES = {name: text for name, text in entry.oracle_sql().items() if name in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b and type(a) is type(b)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    relation = duck.sql(ORACLES[name])
    assert columns == sorted(relation.columns)
    ours = ordered(tuple(r) for r in result.select(*columns).collect())
    theirs = ordered(relation.select(*[f'"{c}"' for c in columns]).fetchall())
    assert len(ours) == len(theirs) and ours
    assert [(a, b) for a, b in zip(ours, theirs) if not all(map(same, a, b))][:3] == []


def test_every_query_but_the_models_has_a_counterpart():
    assert set(QUERIES) - set(ORACLES) == {"ml_metrics", "ml_scores"}
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", ["silver_reports", "enriched_reports", "enriched_weather", "news_extract", "priority_score", "stats"])
def test_work_stays_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
