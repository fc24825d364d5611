"""Every registered query against its SQL in DuckDB, on whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from sensorloom.plans.registered import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    yield connection
    connection.close()


def cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    answer = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(df.columns) == sorted(names)
    assert bag(df.collect(), df.columns) == bag(answer.fetchall(), names)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["window_start", "window_end", "measure", "mean", "status", "notification"]
    assert df.count() == 3 * 988
