"""Text, CSV and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.columns import PAYLOAD_SCHEMA, numbered_line

# Cell texts that stand for a missing value.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# RFC 4180: a quote inside a quoted field is doubled.
CSV_QUOTING = {"quote": '"', "escape": '"'}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, without its line end."""
    return spark.read.text(path)


def generate_lines(spark: SparkSession, n: int) -> DataFrame:
    """``n`` numbered lines, made in parallel."""
    return spark.range(n).select(numbered_line(F.col("id")).alias("value"))


def lines_of(df: DataFrame, number: str) -> DataFrame:
    """A line for each row, numbered by one of its columns."""
    return df.select(numbered_line(F.col(number)).alias("value"))


def read_headerless_csv(
    spark: SparkSession, path: str, columns: int, multi_line: bool = False
) -> DataFrame:
    """All-string columns ``_c0 .. _cN``; a header line counts as a row.

    Missing values are NULL.  ``multi_line`` allows line ends inside quoted
    fields, at the price that one file is then read by one task.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(columns)])
    cells = spark.read.schema(schema).csv(
        path, header=False, multiLine=multi_line, **CSV_QUOTING
    )
    return cells.select(
        *[F.when(~F.col(c).isin(MISSING), F.col(c)).alias(c) for c in cells.columns]
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines ``{"results": {"sunrise", "sunset"}}`` as a nested column.

    A malformed line raises.
    """
    return spark.read.schema(PAYLOAD_SCHEMA).json(path, mode="FAILFAST")
