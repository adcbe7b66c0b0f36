"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")

QUERIES, ORACLES = __spark_entry__.QUERIES, __spark_entry__.ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def by_column_name(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([record[i] for i in order]) for record in records)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert by_column_name(result.columns, result.collect()) == by_column_name(columns, expected.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
