"""The registered corpus queries against their DuckDB SQL; those without SQL have slow versions elsewhere."""

import os

import duckdb
import pytest

from forecourt.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA
from tests.test_oracles import sorted_rows


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(DATA)):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    return connection


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    found = sorted_rows(df.columns, df.collect())
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert found == sorted_rows(columns, answer.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    table = "pages" if name in ("op1_warc", "op8_url_models") else "documents"
    rows = spark.read.parquet(f"{DATA}/{table}.parquet").count()
    found = QUERIES[name](spark, DATA).count()
    assert found == rows or name == "op10_length_histogram"
