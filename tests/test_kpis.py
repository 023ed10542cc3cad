"""The KPIs on small tables, planned for small and for large join sides."""

import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidelake.operators.kpis import (
    low_stock_products,
    top_orders_by_value,
    top_products_sold,
    total_orders,
)
from tidelake.plans.gold import kpis, loaded_by

ORDERS = "orderid INT, customerid INT, orderdate STRING, totalamount DOUBLE, date DATE"
CUSTOMERS = "customerid INT, firstname STRING, lastname STRING, date DATE"
ITEMS = "productid INT, quantity INT, date DATE"
PRODUCTS = "productid INT, productname STRING, stockquantity INT, date DATE"
D1, D2 = date(2025, 1, 1), date(2025, 1, 2)


@pytest.fixture(params=["small", "large"])
def join_sides(request):
    if request.param == "large":
        request.getfixturevalue("large_tables")
    return request.param


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_total_orders_counts_distinct_ids(spark):
    df = spark.createDataFrame(
        [(1, 1, "d", 1.0, D1), (1, 1, "d", 1.0, D2), (None, 1, "d", 1.0, D1)], ORDERS
    )
    assert rows(total_orders(df)) == [(1, D2)]


def test_total_orders_of_nothing_is_one_row(spark):
    assert rows(total_orders(spark.createDataFrame([], ORDERS))) == [(0, None)]


@pytest.mark.parametrize("many", [False, True])
def test_top_orders(spark, join_sides, many):
    orders = spark.createDataFrame(
        [
            (7, 1, "d7", 70.0, D1),
            (6, 1, "d6", 60.0, D1),
            (5, 99, "orphan", 65.0, D1),
            (4, None, "no customer", 80.0, D1),
            (2, 2, "d2", 60.0, D1),
            (1, 2, "d1", None, D1),
            (3, 1, "d3", 10.0, D1),
        ],
        ORDERS,
    )
    customers = spark.createDataFrame([(1, "A", "B", D1), (2, "C", "D", D1)], CUSTOMERS)
    assert rows(top_orders_by_value(orders, customers, 4, many)) == [
        (7, "A", "B", 70.0, "d7"),
        (2, "C", "D", 60.0, "d2"),
        (6, "A", "B", 60.0, "d6"),
        (3, "A", "B", 10.0, "d3"),
    ]
    assert rows(top_orders_by_value(orders, customers, 9, many))[-1] == (1, "C", "D", None, "d1")


@pytest.mark.parametrize("many", [False, True])
def test_top_orders_shows_copies(spark, join_sides, many):
    """An order loaded twice, and a customer kept twice, appear as often as they join."""
    orders = spark.createDataFrame([(1, 1, "d", 5.0, D1), (1, 1, "d", 5.0, D2)], ORDERS)
    customers = spark.createDataFrame([(1, "A", "B", D1), (1, "A", "C", D1)], CUSTOMERS)
    assert rows(top_orders_by_value(orders, customers, 3, many)) == [
        (1, "A", "B", 5.0, "d"), (1, "A", "B", 5.0, "d"), (1, "A", "C", 5.0, "d"),
    ]


def test_one_answer_for_small_and_large_sides(spark, folder):
    """Orders without a customer, repeated orders and repeated customers, from Parquet files."""
    spark.createDataFrame(
        [(i, None, "d", 500.0 + i, D1) for i in range(98)]
        + [(200, 1, "d", 400.0, D1)] * 4
        + [(300 + i, 2 + i % 3, "d", 300.0, D1) for i in range(30)],
        ORDERS,
    ).write.parquet(f"{folder}/orders")
    spark.createDataFrame(
        [(1, "A", "1", D1), (1, "B", "2", D1), (1, "C", "3", D1), (2, "D", "4", D1), (9, "E", "5", D1)], CUSTOMERS
    ).write.parquet(f"{folder}/customers")
    key, found = "spark.sql.autoBroadcastJoinThreshold", []
    before = spark.conf.get(key)
    try:
        for limit in ("10MB", "-1"):
            spark.conf.set(key, limit)
            orders, customers = (spark.read.parquet(f"{folder}/{t}") for t in ("orders", "customers"))
            found += [rows(top_orders_by_value(orders, customers, many_customers=many)) for many in (False, True)]
    finally:
        spark.conf.set(key, before)
    assert all(f == found[0] for f in found)
    assert [r[1] for r in found[0]] == ["A", "A", "A", "A", "B"]


def final_plan(df):
    df.collect()
    return re.split(r"\n\+- == Initial Plan", df._jdf.queryExecution().executedPlan().toString())[0]


def test_only_high_orders_are_shuffled_for_many_customers(spark, folder, large_tables):
    """Ties at the cut are in; the other orders' branch falls away once enough are found."""
    chance = random.Random(6)
    orders = [(i, chance.randrange(60), "d", float(chance.randrange(40)), D1) for i in range(3000)]
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{folder}/orders")
    spark.createDataFrame([(i, "A", str(i), D1) for i in range(50)], CUSTOMERS).write.parquet(f"{folder}/customers")
    tables = [spark.read.parquet(f"{folder}/{t}") for t in ("orders", "customers")]
    for k in (1, 5, 40):
        plain, cut = (top_orders_by_value(*tables, k, many) for many in (False, True))
        assert rows(plain) == rows(cut)
        assert "Union" not in final_plan(cut)
    none = tables[1].where("customerid = 7")
    plain, cut = (top_orders_by_value(tables[0], none, 30, many) for many in (False, True))
    assert rows(plain) == rows(cut) and len(rows(cut)) == 30
    assert "Union" in final_plan(cut)
    nothing = tables[0].limit(0), tables[0].withColumn("totalamount", F.lit(None).cast("double"))
    for df in nothing:
        assert rows(top_orders_by_value(df, tables[1], 3, True)) == rows(top_orders_by_value(df, tables[1], 3))


def test_top_products(spark, join_sides):
    items = spark.createDataFrame(
        [(1, 5, D1), (1, None, D1), (2, 4, D1), (3, 3, D1), (9, 100, D1), (None, 50, D1), (4, None, D1)],
        ITEMS,
    )
    products = spark.createDataFrame(
        [(1, "pen", 1, D1), (2, "cup", 1, D1), (3, "pen", 1, D1), (3, "pen", 1, D1), (4, "hat", 1, D1)],
        PRODUCTS,
    )
    assert rows(top_products_sold(items, products)) == [("pen", 11), ("cup", 4), ("hat", None)]


def test_low_stock_takes_unknown_first_and_breaks_ties_by_id(spark):
    products = spark.createDataFrame(
        [(3, "c", 1, D1), (1, "a", 1, D1), (2, "b", None, D1), (4, "d", 0, D1), (5, "e", 9, D1)],
        PRODUCTS,
    )
    assert rows(low_stock_products(products, k=4)) == [("b", None), ("d", 0), ("a", 1), ("c", 1)]


def test_as_of_leaves_later_loads_out(spark):
    tables = {
        "orders": spark.createDataFrame([(1, 1, "d", 1.0, D1), (2, 1, "d", 2.0, D2)], ORDERS),
        "customers": spark.createDataFrame([(1, "A", "B", D1)], CUSTOMERS),
        "orderitems": spark.createDataFrame([(1, 5, D1), (1, 7, D2)], ITEMS),
        "products": spark.createDataFrame([(1, "pen", 3, D1), (2, "cup", 1, D2)], PRODUCTS),
    }
    early = kpis({name: loaded_by(df, D1) for name, df in tables.items()})
    assert rows(early["total_orders"]) == [(1, D1)]
    assert rows(early["top_5_products_sold"]) == [("pen", 5)]
    assert rows(early["low_stock_products"]) == [("pen", 3)]
    assert rows(kpis(tables)["total_orders"]) == [(2, D2)]
