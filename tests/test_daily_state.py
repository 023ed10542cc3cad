"""KPI states by day against the KPIs over all days."""

import os
import random
import shutil
from datetime import date, timedelta

import pytest
from pyspark.sql import types as T

from tidelake.operators.kpis import top_products_sold, total_orders
from tidelake.plans import bronze, daily_state
from tidelake.plans.daily_state import DailyState, DistinctIds, SumByKey
from tidelake.sources import lake
from tidelake.specs import TableSpec

SPEC = TableSpec(
    "sales",
    T.StructType(
        [
            T.StructField("orderid", T.LongType()),
            T.StructField("productid", T.LongType()),
            T.StructField("quantity", T.IntegerType()),
            T.StructField("day", T.StringType()),
        ]
    ),
    day_column="day",
)
DAYS = [date(2025, 1, 1) + timedelta(days=i) for i in range(6)]


def book(spark, folder, day, rows):
    """The day's rows in the place of those that were there."""
    df = spark.createDataFrame([(*r, day.isoformat()) for r in rows], SPEC.schema)
    bronze.load(df, SPEC, folder, day)


def states(folder):
    return (
        DailyState("ids", SPEC, DistinctIds("orderid"), f"{folder}/state"),
        DailyState("units", SPEC, SumByKey("productid", "quantity"), f"{folder}/state"),
    )


def check(spark, folder):
    ids, units = states(folder)
    table = lake.snapshot_scan(spark, SPEC, f"{folder}/sales")
    products = spark.createDataFrame([(i, f"p{i % 4}") for i in range(8)], "productid LONG, productname STRING")
    assert daily_state.total_orders(spark, ids).collect() == total_orders(table).collect()
    kept = daily_state.units_sold(spark, units)
    assert top_products_sold(kept, products).collect() == top_products_sold(table, products).collect()
    return ids, units


def test_states_follow_new_rewritten_and_removed_days(spark, folder):
    chance = random.Random(1)
    ids = [None, 0, -1, -40_000, 1, 32_768, 32_769, 2**31, 2**62, *range(50)]
    for step in range(9):
        for day in chance.sample(DAYS, 2):
            rows = [
                (chance.choice(ids), chance.choice([None, *range(8)]), chance.choice([None, 1, 5, 9]))
                for _ in range(chance.randrange(1, 20))
            ]
            book(spark, folder, day, rows)
        if step == 6:
            gone = sorted(n for n in os.listdir(f"{folder}/sales".removeprefix("file:")) if n.startswith("date="))[0]
            shutil.rmtree(f"{folder}/sales/{gone}".removeprefix("file:"))
        for state in states(folder):
            state.update(spark, folder)
        check(spark, folder)
    for state in states(folder):
        assert not state.update(spark, folder).written
        stored = f"{folder}/state/{state.name}/days".removeprefix("file:")
        assert all(len([n for n in os.listdir(f"{stored}/{d}") if "=" in n]) <= 1 for d in os.listdir(stored) if "=" in d)


def test_old_days_are_not_read(spark, folder):
    """A new day, and for sums a rewritten one, go in though the files of all other days are unreadable."""
    for day in DAYS[:4]:
        book(spark, folder, day, [(day.day, 1, day.day), (1, 2, 3)])
    ids, units = states(folder)
    for state in (ids, units):
        state.update(spark, folder)
    for at, _, names in os.walk(f"{folder}/sales".removeprefix("file:")):
        for name in names:
            with open(f"{at}/{name}", "wb") as file:
                file.write(b"no longer a table")
    book(spark, folder, DAYS[4], [(70, 1, 10), (1, 3, 4)])
    for state in (ids, units):
        state.update(spark, folder)
    assert [tuple(r) for r in daily_state.total_orders(spark, ids).collect()] == [(5, DAYS[4])]
    book(spark, folder, DAYS[0], [(9, 1, 100)])
    for state in (ids, units):
        state.update(spark, folder)
    sold = {r.productid: r.quantity for r in daily_state.units_sold(spark, units).collect()}
    assert sold == {1: 100 + 2 + 3 + 4 + 10, 2: 9, 3: 4}
    assert [tuple(r) for r in daily_state.total_orders(spark, ids).collect()] == [(6, DAYS[4])]


def test_nothing_yet(spark, folder):
    ids, units = states(folder)
    with pytest.raises(FileNotFoundError):
        ids.read(spark)
    for state in (ids, units):
        state.update(spark, folder)
    assert [tuple(r) for r in daily_state.total_orders(spark, ids).collect()] == [(0, None)]
    assert daily_state.units_sold(spark, units).collect() == []


def test_a_run_that_died_is_repeated(spark, folder, monkeypatch):
    _, units = states(folder)
    book(spark, folder, DAYS[0], [(1, 1, 5)])
    units.update(spark, folder)
    book(spark, folder, DAYS[0], [(1, 1, 7), (1, 2, 1)])

    def died(*_):
        raise OSError("died")

    with monkeypatch.context() as patch:
        patch.setattr(daily_state, "replace_table", died)
        with pytest.raises(OSError):
            units.update(spark, folder)
    assert {r.productid: r.quantity for r in daily_state.units_sold(spark, units).collect()} == {1: 5}
    units.update(spark, folder)
    assert {r.productid: r.quantity for r in daily_state.units_sold(spark, units).collect()} == {1: 7, 2: 1}
