"""Relational tables and queries over JDBC.

The driver jar is the user's to supply (``--jars``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# URL prefix, driver class and sub-query alias.
SQLITE_URL = "jdbc:sqlite:{database}"
SQLITE_DRIVER = "org.sqlite.JDBC"
QUERY_ALIAS = "tmp"


def relation(table: str, query: str | None) -> str:
    """The ``dbtable`` text: the query as a sub-query, or the bare table."""
    return f"({query}) AS {QUERY_ALIAS}" if query else table


def sqlite_options(database: str) -> dict[str, str]:
    return {"url": SQLITE_URL.format(database=database), "driver": SQLITE_DRIVER}


def jdbc_scan(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    query: str | None = None,
    schema: str | None = None,
    partition_column: str | None = None,
    num_partitions: int = 1,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Lazy scan of a table or query; filters on it are pushed to the database.

    With a ``partition_column`` the scan is split into ``num_partitions`` key
    ranges between the column's least and greatest value, which a one-row query
    fetches first.  ``schema`` overrides the driver's column types.
    """
    options = dict(connection) | {
        "dbtable": relation(table, query),
        "fetchsize": str(fetch_size),
    }
    if schema:
        options["customSchema"] = schema
    if partition_column and num_partitions > 1:
        bounds = (
            f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi "
            f"FROM {relation(table, query)}"
        )
        lo, hi = (
            spark.read.format("jdbc")
            .options(**dict(connection), dbtable=relation("", bounds))
            .load()
            .first()
        )
        if lo is not None:
            options |= {
                "partitionColumn": partition_column,
                "lowerBound": str(lo),
                "upperBound": str(hi),
                "numPartitions": str(num_partitions),
            }
    return spark.read.format("jdbc").options(**options).load()
