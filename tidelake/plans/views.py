"""The four sales tables as views of TPC-H-like Parquet tables.

``sf_dir`` holds ``customer``, ``part``, ``orders`` and ``lineitem`` files.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINES_PER_ORDER = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_text(timestamp: Column | str) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customerid"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("firstname"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("lastname"),
        F.concat(F.lit("c"), "c_custkey", F.lit("@example.com")).alias("email"),
        F.concat_ws("-", "c_nationkey", "c_custkey").alias("phone"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p_size`` stands in for the stock."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("productid"),
        F.col("p_name").alias("productname"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").cast("bigint").alias("stockquantity"),
    )


def orderitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item ids repeat, as (order, line) does in the source."""
    return orderitems_of(table(spark, sf_dir, "lineitem"))


def orderitems_of(lines: DataFrame) -> DataFrame:
    return lines.select(
        (F.col("l_orderkey") * LINES_PER_ORDER + F.col("l_linenumber")).alias("orderitemid"),
        F.col("l_orderkey").alias("orderid"),
        F.col("l_partkey").alias("productid"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("itemprice"),
    )


def _order_columns() -> list[Column]:
    return [
        F.col("o_orderkey").alias("orderid"),
        F.col("o_custkey").alias("customerid"),
        day_text("o_orderdate").alias("orderdate"),
        F.col("o_totalprice").alias("totalamount"),
    ]


def orders(
    spark: SparkSession, sf_dir: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Orders with a text day.

    A filter on the computed text cannot reach the Parquet file, so a caller who
    wants some days gives them as bounds on the stored timestamp, which can.
    """
    source = table(spark, sf_dir, "orders")
    placed = F.col("o_orderdate")
    if first is not None:
        source = source.where(placed >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        source = source.where(placed < F.lit(last + timedelta(days=1)).cast("timestamp_ntz"))
    return source.select(*_order_columns())


def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as silver holds them: every day loaded under its own date."""
    return table(spark, sf_dir, "orders").select(
        *_order_columns(), F.col("o_orderdate").cast("date").alias("date")
    )


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a shop that books once a month: the day is the month's first."""
    return orders(spark, sf_dir).withColumn(
        "orderdate", F.concat(F.left("orderdate", F.lit(7)), F.lit("-01"))
    )


def sales_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, sf_dir),
        "products": products(spark, sf_dir),
        "orderitems": orderitems(spark, sf_dir),
        "orders": orders(spark, sf_dir),
    }
