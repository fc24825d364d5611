import duckdb
import pytest

from sensorloom.llm.oracles import ORACLES
from sensorloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_its_sql(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    with duckdb.connect() as db:
        for table in ("documents", "embeddings", "pages"):
            db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        expected = db.sql(ORACLES[name])
        assert sorted(expected.columns) == sorted(found.columns)
        columns = sorted(found.columns)
        rows = expected.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(str, map(tuple, found.select(*columns).collect()))) == sorted(map(str, rows))
