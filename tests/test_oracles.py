"""Every registered query against its SQL in DuckDB."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tidelake.oracles import ORACLES
from tidelake.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_sql():
    assert set(ORACLES) == set(REGISTRY)
    assert set(REGISTRY) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def check(spark, duck, name):
    result = driver.queries()[name](spark, SF_DIR)
    cursor = duck.execute(driver.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    assert {c: SPARK_TO_DUCKDB[t] for c, t in result.dtypes} == types
    got = [tuple(row) for row in result.collect()]
    assert len(got) == len(expected) > 0
    assert sorted_rows(result.columns, got) == sorted_rows(list(types), expected)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_matches_sql(spark, duck, name):
    check(spark, duck, name)


@pytest.mark.parametrize(
    "name",
    ["gold_top5_orders_value", "gold_top5_products_sold", "silver_latest_by_key", "kpi_report"],
)
def test_matches_sql_with_large_join_sides(spark, duck, large_tables, name):
    check(spark, duck, name)


def test_flagship_runs(spark):
    assert driver.entry(spark).count() == 5
