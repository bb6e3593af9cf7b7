"""Each query against its SQL twin on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from kinrate.catalog.oracle import ORACLE
from kinrate.catalog.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ("part", "orders", "lineitem")
UNWANTED = ("PythonUDF", "ArrowEval", "BatchEval", "CartesianProduct", "NestedLoop")
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)
    assert QUERIES.items() <= entry.queries().items()


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, sql, name):
    got = entry.queries()[name](spark, DATA)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]
    expected = sql.execute(entry.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in expected.description}
    assert {c: TYPES[t] for c, t in got.dtypes} == types
    columns = sorted(types)
    places = [list(types).index(c) for c in columns]
    rows = sorted(repr([row[i] for i in places]) for row in expected.fetchall())
    assert sorted(repr([row[c] for c in columns]) for row in got.collect()) == rows
