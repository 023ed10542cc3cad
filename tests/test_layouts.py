"""Files that skip data, compaction of days, and prints of contents."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidelake.operators.guards import fingerprinted
from tidelake.plans import audit, bronze, compaction, daily_state, silver
from tidelake.sinks.lake import Layout, write_days
from tidelake.sources import lake
from tidelake.specs import SALES

ORDERS = SALES["orders"]
DAYS = [date(2025, 1, 1) + timedelta(days=i) for i in range(12)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def scanned(df):
    """Rows that come out of the file scan: those of row groups that were not skipped."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups(spark, folder):
    """By range of the sorted key, and by Bloom filter of a column that lies in any order."""
    chance = random.Random(1)
    ids = chance.sample(range(10**6), 40_000)
    df = spark.createDataFrame([(i, 7 * chance.randrange(10**8), str(DAYS[0]), 1.0) for i in ids], ORDERS.schema)
    df = df.withColumn("date", F.lit(DAYS[0])).cache()
    paths = {}
    for name, layout in (("plain", Layout(row_group_bytes=1 << 16)),
                         ("laid out", Layout(("orderid",), ("customerid",), row_group_bytes=1 << 16))):
        paths[name] = f"{folder}/{name}"
        write_days(df, "orders", paths[name], layout=layout)
    wanted = df.first()
    read = {name: lake.snapshot_scan(spark, ORDERS, path) for name, path in paths.items()}
    assert rows(read["plain"]) == rows(read["laid out"])
    by_id, by_customer = F.col("orderid") == wanted.orderid, F.col("customerid") == wanted.customerid
    for condition in (by_id, by_customer):
        assert rows(read["plain"].where(condition)) == rows(read["laid out"].where(condition)) != []
        assert scanned(read["plain"].where(condition)) > 30_000
        assert scanned(read["laid out"].where(condition)) < 12_000


def test_equal_keys_spread_over_files(spark, folder):
    df = spark.createDataFrame([(7 if i % 3 else i, i, str(DAYS[0]), 1.0) for i in range(30_000)], ORDERS.schema)
    write_days(df.withColumn("date", F.lit(DAYS[0])), "orders", folder, layout=Layout(("orderid",)))
    sizes = [r["n"] for r in lake.snapshot_scan(spark, ORDERS, folder).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 4 and max(sizes) < 2 * 30_000 / len(sizes)


def order_rows(spark, *given):
    return spark.createDataFrame([(i, 1, str(day), amount) for i, day, amount in given], ORDERS.schema)


def book(spark, folder, *given):
    days = [day for _, day, _ in given]
    bronze.backfill(order_rows(spark, *given), ORDERS, f"{folder}/bronze", min(days), max(days))


@pytest.mark.parametrize("target", [4000, 1 << 20])
def test_compaction_keeps_rows_and_bounds_files(spark, folder, target):
    chance = random.Random(2)
    path, expected = f"{folder}/bronze/orders", {}

    def put(day):
        expected[day] = [(chance.randrange(99), day, float(chance.randrange(9))) for _ in range(chance.randrange(1, 30))]
        book(spark, folder, *expected[day])

    def check():
        want = sorted(((i, 1, str(d), a, d) for own in expected.values() for i, d, a in own), key=str)
        assert rows(lake.snapshot_scan(spark, ORDERS, path)) == want
        assert rows(lake.stored_scan(spark, ORDERS, path)) == want
        for day in DAYS:
            assert rows(lake.partition_scan(spark, ORDERS, path, day)) == [r for r in want if r[4] == day]
            assert rows(lake.stored_scan(spark, ORDERS, path, [str(day)])) == [r for r in want if r[4] == day]
        assert set(lake.bronze_days(spark, ORDERS, path)) == {str(d) for d in expected}

    for day in DAYS[:8]:
        put(day)
    prints = lake.bronze_days(spark, ORDERS, path)
    total = sum(compaction.day_sizes(spark, path).values())
    files = compaction.compact(spark, ORDERS, path, DAYS[5], target)
    assert 1 <= files <= 2 * total / target + 1
    assert lake.folder_days(spark, path) == {str(d) for d in DAYS[6:8]}
    assert lake.bronze_days(spark, ORDERS, path) == prints
    check()
    for day in (DAYS[2], DAYS[9], DAYS[6]):
        put(day)
        check()
    assert compaction.compact(spark, ORDERS, path, DAYS[-1], target)
    assert not lake.folder_days(spark, path)
    check()
    assert compaction.compact(spark, ORDERS, path, DAYS[-1], target) == 0
    put(DAYS[10])
    check()
    with pytest.raises(ValueError, match="compacted"):
        bronze.load(order_rows(spark, (1, DAYS[2], 1.0)), ORDERS, f"{folder}/bronze", DAYS[2], "append")


def test_what_was_made_from_days_is_not_made_again(spark, folder):
    """States, streams of days and silver loads see no change in a compaction."""
    for day in DAYS[:4]:
        book(spark, folder, (day.day, day, 1.0))
    state = daily_state.DailyState("ids", ORDERS, daily_state.DistinctIds("orderid"), f"{folder}/state")
    state.update(spark, f"{folder}/bronze")
    compaction.compact(spark, ORDERS, f"{folder}/bronze/orders", DAYS[2])
    assert not state.update(spark, f"{folder}/bronze").written
    silver.incremental(spark, ORDERS, f"{folder}/bronze", f"{folder}/silver", DAYS[0], DAYS[3])
    assert lake.snapshot_scan(spark, ORDERS, f"{folder}/silver/orders").count() == 4


def test_a_compaction_that_died_changes_nothing(spark, folder, monkeypatch):
    for day in DAYS[:4]:
        book(spark, folder, (day.day, day, 1.0))
    before = rows(lake.snapshot_scan(spark, ORDERS, f"{folder}/bronze/orders"))

    def died(*_, **__):
        raise OSError("died")

    for step in ("publish", "folders.remove"):
        with monkeypatch.context() as patch:
            patch.setattr(f"tidelake.plans.compaction.{step}", died)
            with pytest.raises(OSError):
                compaction.compact(spark, ORDERS, f"{folder}/bronze/orders", DAYS[-1])
        assert rows(lake.snapshot_scan(spark, ORDERS, f"{folder}/bronze/orders")) == before
    compaction.compact(spark, ORDERS, f"{folder}/bronze/orders", DAYS[-1])
    assert rows(lake.snapshot_scan(spark, ORDERS, f"{folder}/bronze/orders")) == before


def test_bins_are_ranges_of_about_equal_size():
    sizes = {f"2025-01-{d:02d}": n for d, n in enumerate([5, 5, 5, 30, 1, 1, 1, 100, 9, 9, 9, 9], 1)}
    bins = compaction.packed_days(sizes, 40)
    assert "2025-01-08" not in bins and list(bins) == sorted(bins)
    assert list(bins.values()) == sorted(bins.values())
    per_bin = {}
    for day, n in bins.items():
        per_bin[n] = per_bin.get(n, 0) + sizes[day]
    assert max(per_bin.values()) <= 40 and len(per_bin) <= 4
    assert compaction.packed_days({}, 40) == {}


def printed(df):
    df, seen = fingerprinted(df)
    df.write.format("noop").mode("overwrite").save()
    return seen.get["rows"], seen.get["fingerprint"]


def test_a_print_is_of_the_rows_only(spark):
    given = [(1, None, "a"), (None, 1, "a"), (2, 2, None), (2, 2, None), (3, 0, "")]
    df = spark.createDataFrame(given, "x INT, y INT, z STRING")
    base = printed(df)
    assert base == printed(df.repartition(3).select("z", "x", "y")) and base[0] == 5
    for change in (
        given[:-1],
        [*given, given[2]],
        [(None, 1, "a"), (None, 1, "a"), *given[2:]],
        [*given[:4], (3, None, "")],
        [*given[:4], (3, 0, None)],
    ):
        assert printed(spark.createDataFrame(change, df.schema)) != base
    assert printed(df.limit(0)) == (0, None)


def test_a_changed_cell_between_layers_is_found(spark, folder):
    """From the prints alone: the bronze files are gone when the audit is asked."""
    parts = [(DAYS[0], DAYS[1]), (DAYS[2], DAYS[2]), (DAYS[3], DAYS[4])]
    source = order_rows(spark, *[(10 * d.day + i, d, 1.0 * i) for d in DAYS[:4] for i in range(5)])
    for first, last in parts:
        bronze.backfill(source, ORDERS, f"{folder}/bronze", first, last, audits_root=f"{folder}/audits")
    changed = source.withColumn("totalamount", F.when(F.col("orderid") == 32, 7.5).otherwise(F.col("totalamount")))
    bronze.load(changed, ORDERS, f"{folder}/bronze", DAYS[2])
    for first, last in parts:
        silver.incremental(spark, ORDERS, f"{folder}/bronze", f"{folder}/silver", first, last, audits_root=f"{folder}/audits")
    os.rename(f"{folder}/bronze".removeprefix("file:"), f"{folder}/gone".removeprefix("file:"))
    found = rows(audit.audited(spark, f"{folder}/audits"))
    assert found == [
        ("orders", DAYS[0], DAYS[1], 10, 10, True),
        ("orders", DAYS[2], DAYS[2], 5, 5, False),
        ("orders", DAYS[3], DAYS[4], 5, 5, True),
    ]
    os.rename(f"{folder}/gone".removeprefix("file:"), f"{folder}/bronze".removeprefix("file:"))
    bronze.load(source, ORDERS, f"{folder}/bronze", DAYS[2], audits_root=f"{folder}/audits")
    silver.incremental(spark, ORDERS, f"{folder}/bronze", f"{folder}/silver", DAYS[2], audits_root=f"{folder}/audits")
    assert all(r[-1] for r in rows(audit.audited(spark, f"{folder}/audits")))
