"""The four sales KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.operators.topk import top_k, top_k_before_join, top_k_joined
from tidelake.specs import LOAD_DATE

# Fixed value: every ranking KPI keeps five rows.
TOP = 5


def total_orders(orders: DataFrame) -> DataFrame:
    """Exact distinct orders and newest load date; always one row.

    Spark plans it as a map-side reduced group by order id, then a count.
    """
    return orders.agg(
        F.count_distinct("orderid").alias("total_orders"),
        F.max(LOAD_DATE).alias("ref_date"),
    )


def top_orders_by_value(
    orders: DataFrame, customers: DataFrame, k: int = TOP, many_customers: bool = False
) -> DataFrame:
    """Most valuable orders with the customer's name; orders without one drop out.

    With ``many_customers``, more than can be broadcast, only the highest orders are
    shuffled; the rows are the same.
    """
    ranked = top_k_before_join if many_customers else top_k_joined
    return ranked(
        orders.select("orderid", "customerid", "totalamount", "orderdate"),
        customers.select("customerid", "firstname", "lastname"),
        on="customerid",
        by="totalamount",
        then_by=["orderid"],
        k=k,
    ).select("orderid", "firstname", "lastname", "totalamount", "orderdate")


def top_products_sold(order_items: DataFrame, products: DataFrame, k: int = TOP) -> DataFrame:
    """Best-selling product names by summed quantity; products sharing a name merge.

    Items are summed per product before the join, so a product with a third of
    all items is a few rows by the time it is shuffled.
    """
    sold = order_items.groupBy("productid").agg(F.sum("quantity").alias("quantity"))
    per_name = (
        sold.join(products.select("productid", "productname"), "productid")
        .groupBy("productname")
        .agg(F.sum("quantity").alias("total_sold"))
    )
    return top_k(
        per_name,
        [F.col("total_sold").desc_nulls_last(), F.col("productname").asc_nulls_first()],
        k,
    )


def low_stock_products(products: DataFrame, k: int = TOP) -> DataFrame:
    """Products with the least stock; unknown stock comes first."""
    return top_k(
        products.select("productname", "stockquantity", "productid"),
        [F.col("stockquantity").asc_nulls_first(), F.col("productid").asc_nulls_first()],
        k,
    ).select("productname", "stockquantity")
