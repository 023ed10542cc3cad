"""Bronze, silver, gold, report and streaming over several run dates."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake import folders
from tidelake.operators.guards import ContractError, counted, require_contract
from tidelake.plans import bronze, gold, medallion, report, silver
from tidelake.sinks.lake import overwrite_table, replace_table, write_days
from tidelake.sources import lake
from tidelake.specs import KPIS, SALES, TableSpec
from tidelake.streaming import orders as order_stream

D1, D2, D3 = (date(2025, 1, d) for d in (1, 2, 3))
PRODUCTS, ORDERS = SALES["products"], SALES["orders"]


def products(spark, *rows):
    return spark.createDataFrame([(i, name, 1.0, stock) for i, name, stock in rows], PRODUCTS.schema)


def orders(spark, *rows):
    return spark.createDataFrame(
        [(i, 1, day, amount) for i, day, amount in rows], ORDERS.schema
    )


def local(path):
    return path.removeprefix("file:")


def day_folders(path):
    return sorted(n for n in os.listdir(local(path)) if n.startswith("date="))


def stock(spark, folder):
    rows = lake.snapshot_scan(spark, PRODUCTS, f"{folder}/silver/products").collect()
    return sorted((r.productid, r.stockquantity, r.date) for r in rows)


def test_specs():
    assert list(SALES) == ["customers", "products", "orderitems", "orders"]
    assert ORDERS.query == "SELECT orderid, customerid, orderdate, totalamount FROM orders"
    assert ORDERS.incremental and not PRODUCTS.incremental
    assert list(KPIS) == [
        "total_orders", "top_5_orders_value", "top_5_products_sold", "low_stock_products",
    ]


def test_overwrite_replaces_only_its_day(spark, folder):
    for day, count in ((D1, 1), (D2, 2), (D1, 3)):
        bronze.load(products(spark, (1, "a", count)), PRODUCTS, folder, day)
    rows = lake.snapshot_scan(spark, PRODUCTS, f"{folder}/products").collect()
    assert sorted((r.date, r.stockquantity) for r in rows) == [(D1, 3), (D2, 2)]


def test_append_adds(spark, folder):
    for _ in range(2):
        audit = bronze.load(orders(spark, (1, "2025-01-01", 1.0)), ORDERS, folder, D1, "append")
    assert audit.rows_written == 1
    assert lake.partition_scan(spark, ORDERS, f"{folder}/orders", D1).count() == 2
    with pytest.raises(ValueError):
        bronze.load(orders(spark), ORDERS, folder, D1, mode="ignore")


def test_an_empty_day_writes_no_folder(spark, folder):
    source = orders(spark, (1, "2025-01-01", 1.0))
    assert bronze.load(source, ORDERS, folder, D1).written
    assert not bronze.load(source, ORDERS, folder, D2).written
    assert day_folders(f"{folder}/orders") == ["date=2025-01-01"]
    assert not bronze.load(products(spark), PRODUCTS, folder, D1).written
    assert day_folders(f"{folder}/products") == []


def test_backfill_is_the_union_of_daily_loads(spark, folder):
    source = orders(
        spark,
        (1, "2025-01-01", 1.0), (2, "2025-01-01 10:00:00", 2.0), (3, "2025-01-03", 3.0), (4, None, 4.0),
    )
    bronze.backfill(source, ORDERS, f"{folder}/a", D1, D3)
    for day in (D1, D2, D3):
        bronze.load(source, ORDERS, f"{folder}/b", day)
    a, b = (
        sorted(map(tuple, lake.snapshot_scan(spark, ORDERS, f"{folder}/{x}/orders").collect()))
        for x in "ab"
    )
    assert a == b and len(a) == 2
    with pytest.raises(ValueError):
        bronze.backfill(products(spark), PRODUCTS, folder, D1, D3)


def test_a_hot_day_becomes_several_files(spark, folder):
    """A third of the rows fall on one day; its partition is split, none is lost.

    The sizes are a cluster's in small: far more shuffle partitions than days,
    and only the hot day is larger than the advisory size.
    """
    sizes = {
        "spark.sql.shuffle.partitions": "200",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    }
    before = {key: spark.conf.get(key) for key in sizes}
    n = 120_000
    df = spark.range(0, n, 1, 8).selectExpr(
        "id", "uuid() AS text",
        "IF(id % 3 = 0, date'2025-01-01', date_add(date'2025-02-01', CAST(id % 50 AS INT))) AS date",
    )
    try:
        for key, value in sizes.items():
            spark.conf.set(key, value)
        audit = write_days(df, "t", folder, days="many")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert audit.rows_written == n == spark.read.parquet(folder).count()

    def parts(day):
        return [f for f in os.listdir(f"{local(folder)}/date={day}") if f.endswith(".parquet")]

    assert len(parts("2025-01-01")) > 3
    assert sum(len(parts(d.removeprefix("date="))) for d in day_folders(folder)) < 150


def test_sparse_rows_are_gathered(spark, folder):
    df = spark.range(0, 1000, 1, 50).selectExpr("id", "date'2025-01-01' AS date")
    write_days(df, "t", folder, days="sparse")
    files = [f for f in os.listdir(f"{local(folder)}/date=2025-01-01") if f.endswith(".parquet")]
    assert len(files) <= 8
    with pytest.raises(ValueError):
        write_days(df, "t", folder, days="some")


def test_folder_date_wins_over_file_date(spark, folder):
    df = products(spark, (1, "a", 1)).withColumn("date", F.lit(D2))
    df.write.parquet(f"{folder}/products/date=2025-01-01")
    assert lake.snapshot_scan(spark, PRODUCTS, f"{folder}/products").first().date == D1


def test_partition_scan_prunes_folders(spark, folder):
    for day in (D1, D2):
        bronze.load(products(spark, (1, "a", 1)), PRODUCTS, folder, day)
    scan = lake.partition_scan(spark, PRODUCTS, f"{folder}/products", D2)
    assert [r.date for r in scan.collect()] == [D2]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_counts_in_one_pass(spark):
    df, seen = counted(spark.range(10), big=F.col("id") > 6)
    df.where("id > 100").collect()
    assert seen.get == {"rows": 10, "big": 3}


def test_contracts(spark):
    rows = products(spark)
    with pytest.raises(ContractError, match="date"):
        require_contract(rows, PRODUCTS)
    dated = rows.withColumn("date", F.lit(D1))
    assert require_contract(dated, PRODUCTS) is dated
    with pytest.raises(ContractError, match="primary key"):
        require_contract(dated, TableSpec("t", PRODUCTS.schema))
    with pytest.raises(ContractError, match="missing"):
        require_contract(dated, TableSpec("t", PRODUCTS.schema, key=("nope",)))


SNAPSHOTS = {
    D1: [(1, "a", 10), (2, "b", 20)],
    D2: [(1, "a", 11)],
    D3: [(1, "a", 12), (3, "c", 30), (3, "c", 31)],
}
LATEST = [(1, 12, D3), (2, 20, D1), (3, 30, D3), (3, 31, D3)]


@pytest.mark.parametrize("step", ["full", "refresh"])
def test_silver_keeps_the_latest_and_never_forgets(spark, folder, step):
    """Product 2 left the source after day 1 and stays; product 3 is tied and stays twice."""
    for day, rows in SNAPSHOTS.items():
        bronze.load(products(spark, *rows), PRODUCTS, f"{folder}/bronze", day)
        if step == "refresh":
            silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", day)
    if step == "full":
        silver.full_load(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver")
    assert stock(spark, folder) == LATEST


def test_refresh_of_an_old_or_repeated_day_recomputes(spark, folder):
    for day in (D1, D3):
        bronze.load(products(spark, *SNAPSHOTS[day]), PRODUCTS, f"{folder}/bronze", day)
        silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", day)
    before = stock(spark, folder)
    silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", D3)
    assert stock(spark, folder) == before
    bronze.load(products(spark, (2, "b", 21)), PRODUCTS, f"{folder}/bronze", D2)
    silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", D2)
    assert (2, 21, D2) in stock(spark, folder)


def test_refresh_after_a_run_that_died_recomputes(spark, folder):
    for day in (D1, D2):
        bronze.load(products(spark, *SNAPSHOTS[day]), PRODUCTS, f"{folder}/bronze", day)
    # A version without a pointer: the run died before the switch.
    overwrite_table(
        lake.snapshot_scan(spark, PRODUCTS, f"{folder}/bronze/products").limit(0),
        "products",
        f"{folder}/silver/products/v-dead",
    )
    with pytest.raises(FileNotFoundError):
        lake.silver_tables(spark, f"{folder}/silver", {"products": PRODUCTS})
    silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", D2)
    assert stock(spark, folder) == [(1, 11, D2), (2, 20, D1)]
    assert "v-dead" not in os.listdir(f"{local(folder)}/silver/products")


def test_refresh_merges_every_day_it_has_not_seen(spark, folder):
    """Random days, skipped silver steps, days written again and late ones."""
    chance = random.Random(5)
    for round_ in range(4):
        root = f"{folder}/{round_}"
        for step in range(6):
            day = D1 + timedelta(days=chance.choice([step, step, chance.randrange(6)]))
            rows = [(i, "p", 100 * step + i) for i in chance.sample(range(5), 3)]
            bronze.load(products(spark, *rows), PRODUCTS, f"{root}/bronze", day)
            if step == 0 or chance.random() < 0.5:
                silver.refresh(spark, PRODUCTS, f"{root}/bronze", f"{root}/silver", D1 + timedelta(days=9))
        silver.refresh(spark, PRODUCTS, f"{root}/bronze", f"{root}/silver", D1 + timedelta(days=9))
        refreshed = stock(spark, root)
        silver.full_load(spark, PRODUCTS, f"{root}/bronze", f"{root}/silver")
        assert refreshed == stock(spark, root), round_


def test_days_of_other_stored_types_are_cast(spark, folder):
    source = orders(spark, (1, "2025-01-01", 1.5), (2, "2025-01-02", 2.5))
    for day in (D1, D2):
        bronze.load(source, ORDERS, f"{folder}/bronze", day)
    text = source.where("orderid = 2").select(*[F.col(c).cast("string").alias(c) for c in source.columns])
    text.write.mode("overwrite").parquet(f"{folder}/bronze/orders/date={D2}")
    silver.incremental(spark, ORDERS, f"{folder}/bronze", f"{folder}/silver", D1, D2)
    table = lake.snapshot_scan(spark, ORDERS, f"{folder}/silver/orders")
    assert sorted(r.totalamount for r in table.collect()) == [1.5, 2.5]
    assert stream(order_stream.replace_touched_days, spark, folder) == [(1, 1.5, D1), (2, 2.5, D2)]


def test_nothing_in_bronze_leaves_silver(spark, folder):
    replace_table(
        products(spark, (1, "a", 1)).withColumn("date", F.lit(D1)), "products", f"{folder}/silver/products"
    )
    os.makedirs(f"{local(folder)}/bronze/products")
    audit = silver.full_load(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver")
    assert not audit.written
    assert stock(spark, folder) == [(1, 1, D1)]
    audit = silver.refresh(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", D2)
    assert not audit.written
    assert stock(spark, folder) == [(1, 1, D1)]


def test_one_row_per_key(spark, folder):
    bronze.load(products(spark, *SNAPSHOTS[D3]), PRODUCTS, f"{folder}/bronze", D3)
    silver.full_load(spark, PRODUCTS, f"{folder}/bronze", f"{folder}/silver", ties="one")
    assert [r[:2] for r in stock(spark, folder)] == [(1, 12), (3, 31)]


def test_a_table_is_replaced_by_rows_read_from_it(spark, folder, monkeypatch):
    spec = TableSpec("t", T.StructType([T.StructField("id", T.LongType())]))
    path = f"{folder}/t"

    def ids():
        return sorted(r.id for r in lake.snapshot_scan(spark, spec, path).collect())

    def dated(df):
        return df.select("id", F.lit(D1).alias("date"))

    replace_table(dated(spark.range(10)), "t", path)
    small = lake.snapshot_scan(spark, spec, path).where("id < 3")
    assert replace_table(small, "t", path).rows_written == 3
    assert ids() == [0, 1, 2]
    replace_table(dated(spark.range(5)), "t", path)
    kept = sorted(n for n in os.listdir(local(path)) if not n.startswith("."))
    assert len(kept) == 4, "two versions and two pointers"

    def died(*_):
        raise OSError("died")

    with monkeypatch.context() as patch:
        patch.setattr(folders, "write_new", died)
        with pytest.raises(OSError):
            replace_table(dated(spark.range(1)), "t", path)
    assert ids() == [0, 1, 2, 3, 4], "before the switch readers see the old table"


def test_silver_incremental_rerun_and_append(spark, folder):
    source = orders(spark, (1, "2025-01-01", 1.0), (2, "2025-01-02", 2.0))
    for day in (D1, D2):
        bronze.load(source, ORDERS, f"{folder}/bronze", day)
    for _ in range(2):
        for day in (D1, D2):
            silver.incremental(spark, ORDERS, f"{folder}/bronze", f"{folder}/silver", day)
    table = lake.snapshot_scan(spark, ORDERS, f"{folder}/silver/orders")
    assert table.count() == 2
    silver.incremental(spark, ORDERS, f"{folder}/bronze", f"{folder}/silver", D1, mode="append")
    assert lake.snapshot_scan(spark, ORDERS, f"{folder}/silver/orders").count() == 3
    silver.incremental(spark, ORDERS, f"{folder}/bronze", f"{folder}/silver", D1, last=D2)
    assert lake.snapshot_scan(spark, ORDERS, f"{folder}/silver/orders").count() == 2


def stream(step, spark, folder, **kwargs):
    step(
        spark, ORDERS, f"{folder}/bronze", f"{folder}/silver", f"{folder}/progress", **kwargs
    ).awaitTermination()
    rows = lake.snapshot_scan(spark, ORDERS, f"{folder}/silver/orders").collect()
    return sorted((r.orderid, r.totalamount, r.date) for r in rows)


def test_stream_and_batch_share_a_table(spark, folder):
    step = order_stream.replace_touched_days
    source = orders(spark, (1, "2025-01-01", 1.0), (2, "2025-01-02", 2.0), (3, "2025-01-03", 3.0))
    for day in (D1, D2):
        bronze.load(source, ORDERS, f"{folder}/bronze", day, "append")
    assert len(stream(step, spark, folder, max_files_per_batch=1)) == 2
    assert len(stream(step, spark, folder)) == 2
    bronze.load(source, ORDERS, f"{folder}/bronze", D3, "append")
    silver.incremental(spark, ORDERS, f"{folder}/bronze", f"{folder}/silver", D3)
    assert stream(step, spark, folder) == [(1, 1.0, D1), (2, 2.0, D2), (3, 3.0, D3)]


def test_stream_replaces_rewritten_days(spark, folder):
    step = order_stream.replace_touched_days
    source = orders(spark, (1, "2025-01-01", 1.0), (2, "2025-01-02", 2.0))
    for day in (D1, D2):
        bronze.load(source, ORDERS, f"{folder}/bronze", day)
    assert len(stream(step, spark, folder)) == 2
    corrected = orders(spark, (2, "2025-01-02", 2.5), (4, "2025-01-02", 4.0))
    bronze.load(corrected, ORDERS, f"{folder}/bronze", D2)
    assert stream(step, spark, folder) == [(1, 1.0, D1), (2, 2.5, D2), (4, 4.0, D2)]


def test_missing_kpis_have_typed_defaults(spark, folder):
    for name, spec in KPIS.items():
        df = lake.kpi_scan(spark, folder, D1, name)
        assert df.schema == spec.schema
        assert [tuple(r) for r in df.collect()] == ([(0, None)] if name == "total_orders" else [])
    assert lake.kpi_scan(spark, folder, D1, "unheard_of").columns == []
    assert [tuple(r) for r in report.long_report(spark, folder, D1).collect()] == [
        ("total_orders", 1, None, 0.0)
    ]


def test_headline_without_the_column_is_zero(spark, folder):
    spark.range(3).write.parquet(f"{folder}/date={D1}/total_orders")
    assert report.headline(spark, folder, D1).first().total_orders == 0


def sources(spark, stock_of_pen=5):
    return {
        "customers": spark.createDataFrame([(1, "A", "B", "e", "p")], SALES["customers"].schema),
        "products": products(spark, (1, "pen", stock_of_pen), (2, "cup", 3)),
        "orderitems": spark.createDataFrame(
            [(1, 1, 1, 4, 1.0), (2, 1, 2, 6, 1.0)], SALES["orderitems"].schema
        ),
        "orders": orders(spark, (1, "2025-01-01", 10.0), (2, "2025-01-02", 20.0)),
    }


def report_rows(spark, folder, day):
    return [tuple(r) for r in report.long_report(spark, f"{folder}/gold", day).collect()]


def test_three_runs(spark, folder):
    medallion.run(spark, sources(spark), folder, D1)
    assert report_rows(spark, folder, D1) == [
        ("total_orders", 1, None, 1.0),
        ("top_5_orders_value", 1, "1", 10.0),
        ("top_5_products_sold", 1, "cup", 6.0),
        ("top_5_products_sold", 2, "pen", 4.0),
        ("low_stock_products", 1, "cup", 3.0),
        ("low_stock_products", 2, "pen", 5.0),
    ]
    audits = medallion.run(spark, sources(spark, stock_of_pen=1), folder, D2)
    assert [a.table for a in audits] == [name for name in SALES for _ in range(2)]
    second = report_rows(spark, folder, D2)
    assert second[0][-1] == 2.0
    assert second[1:3] == [("top_5_orders_value", 1, "2", 20.0), ("top_5_orders_value", 2, "1", 10.0)]
    assert second[-2:] == [("low_stock_products", 1, "pen", 1.0), ("low_stock_products", 2, "cup", 3.0)]
    medallion.run(spark, sources(spark, stock_of_pen=1), folder, D2)
    assert report_rows(spark, folder, D2) == second, "running a day again changes nothing"


def test_report_parts_and_preview(spark, folder):
    tables = {k: v.withColumn("date", F.lit(D1)) for k, v in sources(spark).items()}
    paths = gold.build(tables, f"{folder}/gold", D1)
    assert [p.rsplit("/", 1)[1] for p in paths] == list(KPIS)
    assert report.headline(spark, f"{folder}/gold", D1).first().total_orders == 2
    assert report.orders_table(spark, f"{folder}/gold", D1).columns == [
        "orderid", "firstname", "lastname", "totalamount", "orderdate",
    ]
    sold = report.products_series(spark, f"{folder}/gold", D1).collect()
    assert [r.productname for r in sold] == ["cup", "pen"]
    left = report.stock_series(spark, f"{folder}/gold", D1).collect()
    assert [r.stockquantity for r in left] == [3, 5]

    many = products(spark, *[(i, "p", i) for i in range(9, 0, -1)])
    bronze.load(many, PRODUCTS, f"{folder}/bronze", D1)
    head = lake.preview(spark, PRODUCTS, f"{folder}/bronze/products", D1)
    assert [r.productid for r in head.collect()] == [1, 2, 3, 4, 5]
    assert lake.preview(
        spark, PRODUCTS, f"{folder}/bronze/products", D1, n=7, ordered=False
    ).count() == 7
    assert [tuple(r)[:3] for r in lake.describe_columns(head).collect()][-1] == (5, "date", "date")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.preview(spark, PRODUCTS, f"{folder}/nothing", D1)
