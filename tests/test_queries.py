"""Registered queries against their SQL on the small data folder.

The queries of a run start together, four at a time, as most of their time is the fixed cost of small jobs.
"""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry_points
from payscore.registry.oracle import ORACLE
from payscore.registry.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no data folder")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def by_name(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in data), key=str)


@pytest.fixture(scope="module")
def results(spark, request):
    """Columns and rows of every query that is tested in this run, or its failure."""
    names = [item.callspec.params["name"] for item in request.session.items if getattr(item, "originalname", "") == "test_query"]

    def run(name):
        df = QUERIES[name](spark, SF)
        return df.columns, df.collect()

    with ThreadPoolExecutor(4) as pool:
        return {name: pool.submit(run, name) for name in names}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(results, duck, name):
    names, got = by_name(*results[name].result())
    assert got
    done = duck.execute(ORACLE[name])
    columns = [c[0] for c in done.description]
    assert (names, got) == by_name(columns, done.fetchall())


def test_every_statement_belongs_to_a_query():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1500
