"""Silver to gold: the four KPIs of a run date."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.operators.kpis import (
    low_stock_products,
    top_orders_by_value,
    top_products_sold,
    total_orders,
)
from tidelake.specs import LOAD_DATE


def loaded_by(df: DataFrame, day: date) -> DataFrame:
    """The rows of a table loaded by day that were there on ``day``."""
    return df.where(F.col(LOAD_DATE) <= F.lit(day))


def kpis(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """KPI name to frame.

    The KPIs cover all of ``tables``.  Silver's tables give those of its newest day;
    ``history.tables_as_of`` gives the tables of a past one, which silver alone can't,
    as it keeps one version of a key.
    """
    return {
        "total_orders": total_orders(tables["orders"]),
        "top_5_orders_value": top_orders_by_value(tables["orders"], tables["customers"]),
        "top_5_products_sold": top_products_sold(tables["orderitems"], tables["products"]),
        "low_stock_products": low_stock_products(tables["products"]),
    }


def write_kpis(frames: Mapping[str, DataFrame], gold_root: str, run_date: date) -> list[str]:
    """Write each KPI to ``date=<run date>/<kpi>``, replacing it."""
    paths = []
    for name, frame in frames.items():
        path = f"{gold_root}/{LOAD_DATE}={run_date}/{name}"
        frame.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        paths.append(path)
    return paths


def build(tables: Mapping[str, DataFrame], gold_root: str, run_date: date) -> list[str]:
    return write_kpis(kpis(tables), gold_root, run_date)
