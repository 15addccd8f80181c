"""Every query with SQL against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from cellscore.oracle import SQL
from cellscore.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows(found, columns):
    return sorted((tuple(plain(r[c]) for c in columns) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_duckdb(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    relation = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    theirs = [dict(zip(relation.columns, r)) for r in relation.fetchall()]
    assert rows([r.asDict() for r in df.collect()], columns) == rows(theirs, columns)
