"""Every checked query of the library against its DuckDB SQL, over the smallest data folder."""

import math
import os

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as contract
from forecourt.checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(DATA)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{file}'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def sorted_rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(comparable(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    found = sorted_rows(df.columns, df.collect())
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert found == sorted_rows(columns, answer.fetchall())


def test_entry(spark):
    first = contract.entry(spark)
    assert first.columns[0] == "performance_key" and first.limit(1).count() == 1
