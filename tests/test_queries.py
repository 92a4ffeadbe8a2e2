"""Every registered query against its SQL, on the smallest capture."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
import workload

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="captured tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def keyed(rows):
    return sorted(tuple((v is None, type(v).__name__, str(v)) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query_equals_sql(spark, sql, name):
    frame = workload.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    rows = [tuple(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect()]
    question = workload.ORACLES.get(name)
    if question is None:
        assert rows
        return
    cursor = sql.execute(question)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert keyed(rows) == keyed(expected)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert workload.QUERIES.items() <= contract.queries().items()
    assert workload.ORACLES.items() <= contract.oracle_sql().items()
