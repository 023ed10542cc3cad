"""The data behind the daily sales report, read from gold."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.sources.lake import kpi_scan
from tidelake.specs import LOAD_DATE

REPORT_COLUMNS = ("kpi", "position", "label", "value")


def headline(spark: SparkSession, gold_root: str, run_date: date) -> DataFrame:
    """One row: the total, or 0 where it is missing."""
    stored = kpi_scan(spark, gold_root, run_date, "total_orders")
    total = F.max("total_orders") if "total_orders" in stored.columns else F.lit(None)
    return stored.agg(F.coalesce(total, F.lit(0)).cast("bigint").alias("total_orders"))


def orders_table(spark: SparkSession, gold_root: str, run_date: date) -> DataFrame:
    return kpi_scan(spark, gold_root, run_date, "top_5_orders_value").orderBy(
        F.col("totalamount").desc_nulls_last(), F.col("orderid").asc_nulls_first()
    )


def products_series(spark: SparkSession, gold_root: str, run_date: date) -> DataFrame:
    return kpi_scan(spark, gold_root, run_date, "top_5_products_sold").orderBy(
        F.col("total_sold").desc_nulls_last(), F.col("productname").asc_nulls_first()
    )


def stock_series(spark: SparkSession, gold_root: str, run_date: date) -> DataFrame:
    """Ascending, as a horizontal bar chart draws it."""
    return kpi_scan(spark, gold_root, run_date, "low_stock_products").orderBy(
        F.col("stockquantity").asc_nulls_first(), F.col("productname").asc_nulls_first()
    )


def _section(kpi: str, df: DataFrame, label: Column, value: Column, order: list[Column]) -> DataFrame:
    """Number a section's rows; it holds a KPI's few rows, so one task sorts them."""
    return df.select(
        F.lit(kpi).alias("kpi"),
        F.row_number().over(Window.partitionBy(F.lit(kpi)).orderBy(*order)).alias("position"),
        label.cast("string").alias("label"),
        value.cast("double").alias("value"),
    )


def store(spark: SparkSession, gold_root: str, report_root: str, run_date: date) -> DataFrame:
    """The long report of a run date, kept in ``date=<run date>``; a second run replaces it."""
    path = f"{report_root}/{LOAD_DATE}={run_date}"
    rows = long_report(spark, gold_root, run_date)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(rows.schema).parquet(path).orderBy("kpi", "position")


def long_report(spark: SparkSession, gold_root: str, run_date: date) -> DataFrame:
    """All KPIs of a run date as ``kpi, position, label, value``."""
    value = F.col("totalamount")
    sections = [
        _section(
            "total_orders",
            headline(spark, gold_root, run_date),
            F.lit(None),
            F.col("total_orders"),
            [F.col("total_orders")],
        ),
        _section(
            "top_5_orders_value",
            orders_table(spark, gold_root, run_date),
            F.col("orderid"),
            value,
            [value.desc_nulls_last(), F.col("orderid").asc_nulls_first()],
        ),
        _section(
            "top_5_products_sold",
            products_series(spark, gold_root, run_date),
            F.col("productname"),
            F.col("total_sold"),
            [F.col("total_sold").desc_nulls_last(), F.col("productname").asc_nulls_first()],
        ),
        _section(
            "low_stock_products",
            stock_series(spark, gold_root, run_date),
            F.col("productname"),
            F.col("stockquantity"),
            [F.col("stockquantity").asc_nulls_first(), F.col("productname").asc_nulls_first()],
        ),
    ]
    report = sections[0]
    for section in sections[1:]:
        report = report.unionByName(section)
    return report.select(*REPORT_COLUMNS)
