"""Histories against recomputing the day from its snapshots."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidelake.operators.history import as_of, as_of_join, extended, intervals
from tidelake.operators.latest import latest_by_key
from tidelake.plans import bronze, gold, history, silver
from tidelake.sources import lake
from tidelake.specs import SALES

PRODUCTS = SALES["products"]
ROW = "k INT, name STRING, n INT, date DATE"
DAYS = [date(2025, 1, 1) + timedelta(days=2 * i) for i in range(6)]


def snapshots(chance):
    """Rows that come and go, change, stay, are tied or equal, with null keys and values."""
    out = []
    for day in DAYS:
        for k in [None, *range(6)]:
            for _ in range(chance.choice([0, 1, 1, 1, 2])):
                out.append((k, chance.choice(["a", "b", None]), chance.randrange(2), day))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("way", ["at once", "day by day"])
@pytest.mark.parametrize("seed", [1, 2])
def test_every_day_is_what_a_full_load_gave(spark, way, seed):
    df = spark.createDataFrame(snapshots(random.Random(seed)), ROW).cache()
    if way == "at once":
        made = intervals(df, ["k"], DAYS)
    else:
        made = intervals(df.where(F.col("date") == DAYS[0]), ["k"], DAYS[:1])
        for before, day in zip(DAYS, DAYS[1:], strict=False):
            today = df.where(F.col("date") == day)
            ended = made.where("valid_to IS NOT NULL")
            made = ended.unionByName(extended(made.where("valid_to IS NULL"), today, ["k"], day, before))
            made = spark.createDataFrame(made.collect(), made.schema)
    made = made.cache()
    assert rows(made) == rows(intervals(df, ["k"], DAYS))
    for day in [DAYS[0] - timedelta(days=1), *DAYS, *(d + timedelta(days=1) for d in DAYS)]:
        expected = latest_by_key(df.where(F.col("date") <= day), ["k"], "date")
        assert rows(as_of(made, day, DAYS).select(df.columns)) == rows(expected), day


def test_a_row_that_stays_is_one_history_row(spark):
    df = spark.createDataFrame([(1, "a", 1, d) for d in DAYS] + [(2, "b", 1, DAYS[0]), (2, "c", 1, DAYS[3])], ROW)
    assert rows(intervals(df, ["k"], DAYS)) == [
        (1, "a", 1, DAYS[0], DAYS[-1], None, 1),
        (2, "b", 1, DAYS[0], DAYS[0], DAYS[3], 1),
        (2, "c", 1, DAYS[3], DAYS[3], None, 1),
    ]


def test_facts_meet_the_version_of_their_day(spark, large_tables):
    df = spark.createDataFrame(snapshots(random.Random(3)), ROW).where("k IS NOT NULL")
    facts = spark.createDataFrame(
        [(i, i % 6, DAYS[0] + timedelta(days=i % 13 - 1)) for i in range(200)], "id INT, k INT, day DATE"
    )
    got = as_of_join(facts, intervals(df, ["k"], DAYS), "k", "day")
    expected = []
    for day in {r.day for r in facts.collect()}:
        table = latest_by_key(df.where(F.col("date") <= day), ["k"], "date").drop("date")
        expected += rows(facts.where(F.col("day") == day).join(table, "k").select("id", "k", "day", "name", "n"))
    assert rows(got) == sorted(expected, key=str)


def product(spark, *given):
    return spark.createDataFrame([(i, name, 1.0, stock) for i, name, stock in given], PRODUCTS.schema)


def test_plan_follows_bronze(spark, folder):
    """New days, a day written again, a late day and a repeated refresh, with all days as they were."""
    chance = random.Random(4)
    for step in (0, 1, 2, 5, 3, 5, 6):
        given = [(i, chance.choice("pq"), chance.randrange(3)) for i in chance.sample(range(6), 4)]
        bronze.load(product(spark, *given, given[0]), PRODUCTS, f"{folder}/bronze", DAYS[0] + timedelta(days=step))
        assert history.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/history").written
    assert not history.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/history").written
    stored = lake.snapshot_scan(spark, PRODUCTS, f"{folder}/bronze/products").cache()
    for step in range(-1, 8):
        day = DAYS[0] + timedelta(days=step)
        got = history.table_as_of(spark, PRODUCTS, f"{folder}/history", day)
        expected = latest_by_key(stored.where(F.col("date") <= day), ["productid"], "date")
        assert rows(got) == rows(expected.select(got.columns))


def test_ended_rows_are_not_written_again(spark, folder):
    for step in range(5):
        bronze.load(product(spark, (1, "a", step), (2, "b", 0)), PRODUCTS, f"{folder}/bronze", DAYS[step])
        history.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/history")
    parts = lake.current_version(spark, f"{folder}/history/products").parts
    assert sorted(parts) == [*(d.isoformat() for d in DAYS[1:5]), "open"]
    assert len({p.split("/")[0] for p in parts.values()}) == 4
    held = os.listdir(f"{folder.removeprefix('file:')}/history/products")
    assert len([n for n in held if n.startswith("_current-")]) == 2


def test_kpis_of_a_past_day(spark, folder):
    """A product restocked after the day, sold before and after it: silver alone would lose its sales."""
    specs = {name: SALES[name] for name in ("customers", "products", "orderitems", "orders")}
    d1, d2 = DAYS[:2]
    people = lambda name: spark.createDataFrame([(1, "A", name, "e", "p")], SALES["customers"].schema)
    items = lambda *q: spark.createDataFrame([(i, i, 1 + i % 2, n, 1.0) for i, n in q], SALES["orderitems"].schema)
    orders = spark.createDataFrame([(1, 1, str(d1), 5.0), (2, 1, str(d2), 9.0)], SALES["orders"].schema)
    for day, name, stock, sold in ((d1, "old", 7, [(0, 10), (1, 3)]), (d2, "new", 9, [(0, 11), (1, 3), (2, 5)])):
        for table, df in (("customers", people(name)), ("products", product(spark, (1, "a", stock), (2, "b", 4))),
                          ("orderitems", items(*sold)), ("orders", orders)):
            bronze.load(df, specs[table], f"{folder}/bronze", day)
            if specs[table].incremental:
                silver.incremental(spark, specs[table], f"{folder}/bronze", f"{folder}/silver", day)
            else:
                silver.refresh(spark, specs[table], f"{folder}/bronze", f"{folder}/silver", day)
                history.refresh(spark, specs[table], f"{folder}/bronze", f"{folder}/history")

    def kpis(day):
        frames = gold.kpis(history.tables_as_of(spark, specs, f"{folder}/silver", f"{folder}/history", day))
        return {name: [tuple(r) for r in df.collect()] for name, df in frames.items()}

    assert kpis(d1) == {
        "total_orders": [(1, d1)],
        "top_5_orders_value": [(1, "A", "old", 5.0, str(d1))],
        "top_5_products_sold": [("a", 10), ("b", 3)],
        "low_stock_products": [("b", 4), ("a", 7)],
    }
    now = gold.kpis(lake.silver_tables(spark, f"{folder}/silver", specs))
    assert kpis(d2) == {name: [tuple(r) for r in df.collect()] for name, df in now.items()}


def test_first_refresh_stops_at_the_run_date(spark, folder):
    for step, day in enumerate(DAYS[:3]):
        bronze.load(product(spark, (1, "a", step), (step, "b", step)), PRODUCTS, f"{folder}/bronze", day)
    silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", DAYS[0])
    silver.full_load(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/other", upto=DAYS[0])
    first = [rows(lake.snapshot_scan(spark, PRODUCTS, f"{folder}/{s}/products")) for s in ("silver", "other")]
    assert first[0] == first[1] == [(0, "b", 1.0, 0, DAYS[0]), (1, "a", 1.0, 0, DAYS[0])]
    silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", DAYS[2])
    silver.full_load(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/other")
    last = [rows(lake.snapshot_scan(spark, PRODUCTS, f"{folder}/{s}/products")) for s in ("silver", "other")]
    assert last[0] == last[1]
    # An older run date does not take silver back.
    silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", DAYS[0])
    assert rows(lake.snapshot_scan(spark, PRODUCTS, f"{folder}/silver/products")) == last[0]


def size_of(path):
    return sum(os.path.getsize(f"{at}/{n}") for at, _, names in os.walk(path) for n in names if n.endswith(".parquet"))


def test_buckets_without_changed_keys_stay(spark, folder):
    """What a refresh writes follows the changed keys; the result is that of a full load."""
    path = f"{folder.removeprefix('file:')}/silver/products"
    bronze.load(product(spark, *((i, f"name {i}", i) for i in range(4000))), PRODUCTS, f"{folder}/bronze", DAYS[0])
    silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", DAYS[0], buckets=16)
    whole = size_of(path)
    seen = set(os.listdir(path))
    for step, keys in enumerate([[5], [7, 5000], range(0, 4000, 7)], 1):
        bronze.load(product(spark, *((i, "new", step) for i in keys)), PRODUCTS, f"{folder}/bronze", DAYS[step])
        silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", DAYS[step])
        (added,) = [n for n in set(os.listdir(path)) - seen if n.startswith("v-")]
        seen |= set(os.listdir(path))
        touched = len([n for n in os.listdir(f"{path}/{added}") if n.startswith("bucket=")])
        assert touched == min(16, len(keys)) or touched < len(keys) <= 2
        assert size_of(f"{path}/{added}") < 1.5 * whole * touched / 16 + 3000
        silver.full_load(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/other")
        assert rows(lake.snapshot_scan(spark, PRODUCTS, f"{folder}/silver/products")) == rows(
            lake.snapshot_scan(spark, PRODUCTS, f"{folder}/other/products")
        )
    version = lake.current_version(spark, f"{folder}/silver/products")
    assert version.buckets == 16 and sorted(version.parts) == sorted(map(str, range(16)))
    # Folders that no version of the last two names are gone.
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) <= 4
    # A day written again recomputes the table, and it stays in buckets; it can also leave them.
    bronze.load(product(spark, (1, "again", 1)), PRODUCTS, f"{folder}/bronze", DAYS[1])
    silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", DAYS[3])
    assert lake.current_version(spark, f"{folder}/silver/products").buckets == 16
    silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", DAYS[3], buckets=0)
    assert list(lake.current_version(spark, f"{folder}/silver/products").parts) == [""]
    assert (1, "again", 1.0, 1, DAYS[1]) in rows(lake.snapshot_scan(spark, PRODUCTS, f"{folder}/silver/products"))
