"""Every registered query against its SQL twin over the same tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from leafmill.plans.oracles import ORACLES
from leafmill.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    got = Counter(tuple(row[c] for c in order) for row in df.collect())
    want = Counter(tuple(row[columns.index(c)] for c in order) for row in result.fetchall())
    assert sum(want.values()) > 0
    assert got == want


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1500
