"""One query per operator, over the given tables.

Each takes the session and the folder of Parquet tables.  Queries that need a
lake build one from those tables in a new folder of the shared space.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake import folders
from tidelake.functions import columns as C
from tidelake.operators import kpis as K
from tidelake.operators import rows as R
from tidelake.operators.guards import counted
from tidelake.operators.history import as_of_join
from tidelake.operators.latest import latest_by_key
from tidelake.plans import audit, bronze, compaction, daily_state, gold, history, medallion, report, silver, views
from tidelake.plans.daily_state import DailyState, DistinctIds, SumByKey
from tidelake.sinks.files import write_lines, write_positional_csv
from tidelake.sinks.lake import Layout, overwrite_table, write_days
from tidelake.sources import files, lake
from tidelake.sources.sqlite import sqlite_scan, write_sqlite_shards
from tidelake.specs import KPIS, SALES, TableSpec, wide_sales
from tidelake.streaming import corrections
from tidelake.streaming import orders as order_stream
from tidelake.workspace import new_folder, tune

Query = Callable[[SparkSession, str], DataFrame]

WIDE = wide_sales()

# Run dates: parameters of the daily loads, as a scheduler would pass them.
SNAPSHOT_DAYS = (date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 3))
ORDER_DAY = date(1995, 6, 19)
AS_OF_DAY = date(1997, 7, 15)
HISTORY_DAYS = (date(1994, 6, 30), date(1996, 6, 30), date(1998, 3, 31))
DAY_WITHOUT_ORDERS = date(1990, 1, 1)
RUN_DATE = date(2025, 1, 1)

# Stock limits of the products that are still listed in later snapshots.
LISTED_ON_DAY_2 = 25
LISTED_ON_DAY_3 = 10
# Of a table of a few thousand rows; one bucket is meant to be a good file.
PRODUCT_BUCKETS = 8

REGISTRY: dict[str, Query] = {}


def _columns(**types: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in types.items()])


def query(run: Query) -> Query:
    @wraps(run)
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(tune(spark), sf_dir)

    REGISTRY[run.__name__] = tuned
    return tuned


# --- sources ---------------------------------------------------------------


@query
def source_query_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = WIDE["orders"]
    path = new_folder(spark, "source")
    write_sqlite_shards(views.orders(spark, sf_dir), path, spec.name)
    return sqlite_scan(spark, path, spec.name, query=spec.query, schema=spec.schema)


@query
def source_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = WIDE["customers"]
    path = new_folder(spark, "source")
    write_sqlite_shards(views.customers(spark, sf_dir), path, spec.name)
    return sqlite_scan(spark, path, spec.name, schema=spec.schema)


def _product_snapshot(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """Products as of snapshot 0, 1, 2: restocked by one each day, fewer are listed."""
    products = views.products(spark, sf_dir)
    if version >= 1:
        limit = LISTED_ON_DAY_2 if version == 1 else LISTED_ON_DAY_3
        products = products.where(F.col("stockquantity") <= limit)
    return products.withColumn("stockquantity", F.col("stockquantity") + version)


def _load_product_snapshots(spark: SparkSession, sf_dir: str, root: str) -> None:
    for version, day in enumerate(SNAPSHOT_DAYS):
        bronze.load(_product_snapshot(spark, sf_dir, version), WIDE["products"], root, day)


@query
def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "bronze")
    _load_product_snapshots(spark, sf_dir, root)
    return lake.snapshot_scan(spark, WIDE["products"], f"{root}/products")


@query
def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "bronze")
    _load_product_snapshots(spark, sf_dir, root)
    return lake.partition_scan(spark, WIDE["products"], f"{root}/products", SNAPSHOT_DAYS[1])


@query
def partition_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "bronze")
    bronze.load(views.customers(spark, sf_dir), WIDE["customers"], root, RUN_DATE)
    return lake.preview(spark, WIDE["customers"], f"{root}/customers", RUN_DATE)


@query
def generate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line for each order, with its number."""
    return files.lines_of(views.orders(spark, sf_dir), "orderid")


@query
def text_line_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document through text files."""
    raw, done = new_folder(spark, "lines"), new_folder(spark, "lines-done")
    lines = views.table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    write_lines(lines, raw)
    write_lines(
        files.read_lines(spark, raw).select(C.with_done_suffix(F.col("value")).alias("value")),
        done,
    )
    return files.read_lines(spark, done)


@query
def csv_headerless_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A headed CSV read as if it had no header: the header is a row, and is masked too."""
    raw, masked = new_folder(spark, "csv"), new_folder(spark, "csv-masked")
    names = ["c_custkey", "c_mktsegment", "c_name"]
    rows = views.table(spark, sf_dir, "customer").select(
        *[F.col(name).cast("string").alias(name) for name in names]
    )
    header = spark.createDataFrame([tuple(names)], rows.schema)
    header.unionByName(rows).write.csv(raw, header=False, **files.CSV_QUOTING)
    write_positional_csv(
        R.mask_columns(files.read_headerless_csv(spark, raw, columns=3), "_c2"), masked
    )
    return spark.read.csv(masked, header=True, **files.CSV_QUOTING).toDF("c0", "c1", "c2")


def _sun_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON payload for each event's day."""
    day = views.day_text("ts")
    body = F.concat(
        F.lit('{"results":{"sunrise":"'),
        day,
        F.lit('T06:00:00+00:00","sunset":"'),
        day,
        F.lit('T18:00:00+00:00"}}'),
    )
    return views.table(spark, sf_dir, "events").select("event_id", "ts", body.alias("body"))


@query
def json_payload_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "payloads")
    write_lines(_sun_payloads(spark, sf_dir).select("body"), path)
    return files.read_payloads(spark, path).select("results.sunrise", "results.sunset")


@query
def is_night(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's time against the payload of its day."""
    return _sun_payloads(spark, sf_dir).select(
        "event_id", C.payload_is_night(F.col("body"), F.col("ts")).alias("is_night")
    )


# --- rows ------------------------------------------------------------------


@query
def bronze_select_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.select_columns(views.customers(spark, sf_dir), WIDE["customers"])


@query
def bronze_select_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.select_columns(views.products(spark, sf_dir), WIDE["products"])


@query
def bronze_select_orderitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.select_columns(views.orderitems(spark, sf_dir), WIDE["orderitems"])


@query
def bronze_select_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.select_columns(views.orders(spark, sf_dir), WIDE["orders"])


def _text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.orders(spark, sf_dir)
    return orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])


@query
def stabilize_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INT ids, lenient: an id past the INT range is NULL rather than an error."""
    return R.stabilize_types(_text_orders(spark, sf_dir), SALES["orders"], lenient=True)


@query
def stabilize_types_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.stabilize_types(_text_orders(spark, sf_dir), WIDE["orders"])


@query
def load_date_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.stamp_load_date(views.customers(spark, sf_dir).select("customerid"), RUN_DATE)


@query
def mask_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = views.table(spark, sf_dir, "customer")
    return R.mask_columns(customer.select("c_custkey", "c_name", "c_mktsegment"), "c_name")


@query
def text_line_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", C.with_done_suffix(F.col("text")).alias("value")
    )


@query
def document_line_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suffix on every line of every document."""
    lines = views.table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    return lines.select("doc_id", "line_no", C.with_done_suffix(F.col("line")).alias("value"))


@query
def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "pages").select(
        "page_id", C.without_tags(F.col("html")).alias("value")
    )


@query
def bronze_orders_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = ORDER_DAY
    return bronze.transform(views.orders(spark, sf_dir), WIDE["orders"], day)


# --- bronze ----------------------------------------------------------------


@query
def bronze_snapshot_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same snapshot loaded twice is there once."""
    root = new_folder(spark, "bronze")
    for _ in range(2):
        bronze.load(views.customers(spark, sf_dir), WIDE["customers"], root, RUN_DATE)
    return lake.snapshot_scan(spark, WIDE["customers"], f"{root}/customers")


@query
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended twice, it is there twice."""
    root = new_folder(spark, "bronze")
    for _ in range(2):
        bronze.load(views.customers(spark, sf_dir), WIDE["customers"], root, RUN_DATE, "append")
    return lake.snapshot_scan(spark, WIDE["customers"], f"{root}/customers")


@query
def bronze_load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, day = new_folder(spark, "bronze"), ORDER_DAY
    bronze.load(views.orders(spark, sf_dir), WIDE["orders"], root, day)
    return lake.partition_scan(spark, WIDE["orders"], f"{root}/orders", day)


def _order_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    first, last = (
        views.table(spark, sf_dir, "orders")
        .agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date"))
        .first()
    )
    return first, last


@query
def bronze_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, each under its own day, in one job."""
    root = new_folder(spark, "bronze")
    first, last = _order_days(spark, sf_dir)
    bronze.backfill(views.orders(spark, sf_dir), WIDE["orders"], root, first, last)
    return lake.snapshot_scan(spark, WIDE["orders"], f"{root}/orders")


def _text_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly orders as texts, some of them no numbers, some too large for a BIGINT."""
    orders = views.monthly_orders(spark, sf_dir)
    n = F.col("orderid")
    texts = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    return texts.withColumns(
        {
            "customerid": F.when(n % 11 == 0, F.concat("customerid", F.lit("0" * 20))).otherwise(F.col("customerid")),
            "totalamount": F.when(n % 7 == 0, F.lit("n/a")).otherwise(F.col("totalamount")),
        }
    )


def _load_texts(spark: SparkSession, sf_dir: str) -> str:
    root = new_folder(spark, "lake")
    first, _, _, last = _months(spark, sf_dir)
    bookings = _text_bookings(spark, sf_dir)
    bronze.backfill(bookings, WIDE["orders"], f"{root}/bronze", first, last, rejects_root=f"{root}/rejects")
    return root


@query
def bronze_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders whose texts could be cast."""
    return lake.snapshot_scan(spark, WIDE["orders"], f"{_load_texts(spark, sf_dir)}/bronze/orders")


@query
def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of all orders that could not be, with its row's id and the reason."""
    rejects = bronze.rejects_scan(spark, WIDE["orders"], f"{_load_texts(spark, sf_dir)}/rejects")
    errors = rejects.select("date", F.get_json_object("row", "$.orderid").alias("orderid"), F.explode("errors").alias("e"))
    return errors.select("date", "orderid", F.col("e.column").alias("column_name"), "e.text", "e.reason")


@query
def lake_read_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by market segment, with a cut file in the folders of some: what is broken, and what can be read."""
    root, spec = new_folder(spark, "broken"), WIDE["customers"]
    segment = F.col("customerid") % 5
    rows = views.customers(spark, sf_dir).withColumn("date", F.date_add(F.lit(RUN_DATE), segment.cast("int")))
    write_days(rows, spec.name, root, days="many")
    for offset in (1, 3):
        folders.write_new(spark, f"{root}/date={RUN_DATE + timedelta(days=offset)}/part-cut.parquet", "PAR1 and no more")
    readable, errors = lake.readable_days(spark, spec, root)
    day = F.regexp_extract("path", r"/date=([0-9-]+)/", 1).cast("date")
    broken = errors.select(day.alias("date")).groupBy("date").agg(F.count(F.lit(1)).alias("broken_files"))
    there = readable.groupBy("date").agg(F.count(F.lit(1)).alias("readable_rows"))
    broken = spark.createDataFrame(broken.collect(), broken.schema)
    return there.join(broken, "date", "left").select("date", "readable_rows", F.coalesce("broken_files", F.lit(0)).alias("broken_files"))


@query
def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a table as rows."""
    return lake.describe_columns(views.table(spark, sf_dir, "orders"))


@query
def empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of whole tables are written; a day without orders writes nothing."""
    root, day = new_folder(spark, "bronze"), DAY_WITHOUT_ORDERS
    audits = [
        bronze.load(source, WIDE[name], root, day)
        for name, source in views.sales_tables(spark, sf_dir).items()
    ]
    return spark.createDataFrame(
        [(load.table, load.written, load.rows_written) for load in audits],
        "table_name STRING, written BOOLEAN, rows_written BIGINT",
    )


@query
def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and rows kept by the day filter, counted while writing them."""
    day = ORDER_DAY
    on_day = F.col("orderdate") == day.isoformat()
    orders, counts = counted(views.orders(spark, sf_dir), rows_kept=on_day)
    load = write_days(
        R.stamp_load_date(orders.where(on_day), day), "orders", new_folder(spark, "audit")
    )
    seen = counts.get
    return spark.createDataFrame(
        [(seen["rows"], seen["rows_kept"], load.rows_written)],
        "rows_read BIGINT, rows_kept BIGINT, rows_written BIGINT",
    )


# --- silver ----------------------------------------------------------------


def _line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"
    )


@query
def silver_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_key(
        _line_versions(spark, sf_dir), ["l_orderkey", "l_linenumber"], "l_shipdate"
    )


@query
def silver_latest_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key: of the tied rows, the greatest by part, then quantity."""
    return latest_by_key(
        _line_versions(spark, sf_dir), ["l_orderkey", "l_linenumber"], "l_shipdate", ties="one"
    )


@query
def silver_latest_event_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return latest_by_key(events, ["user_id"], "ts")


@query
def silver_full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, spec = new_folder(spark, "lake"), WIDE["products"]
    _load_product_snapshots(spark, sf_dir, f"{root}/bronze")
    silver.full_load(spark, spec, f"{root}/bronze", f"{root}/silver")
    return lake.snapshot_scan(spark, spec, f"{root}/silver/products")


@query
def silver_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table, brought up to date one snapshot at a time."""
    root, spec = new_folder(spark, "lake"), WIDE["products"]
    for version, day in enumerate(SNAPSHOT_DAYS):
        bronze.load(_product_snapshot(spark, sf_dir, version), spec, f"{root}/bronze", day)
        silver.refresh(spark, spec, f"{root}/bronze", f"{root}/silver", day)
    return lake.snapshot_scan(spark, spec, f"{root}/silver/products")


@query
def silver_refresh_after_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table, though the silver step of the second day was lost."""
    root, spec = new_folder(spark, "lake"), WIDE["products"]
    for version, day in enumerate(SNAPSHOT_DAYS):
        bronze.load(_product_snapshot(spark, sf_dir, version), spec, f"{root}/bronze", day)
        if version != 1:
            silver.refresh(spark, spec, f"{root}/bronze", f"{root}/silver", day)
    return lake.snapshot_scan(spark, spec, f"{root}/silver/products")


@query
def silver_refresh_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table from a bronze whose second day is stored as text, the third with INT ids."""
    root, spec = new_folder(spark, "lake"), WIDE["products"]
    for version, day in enumerate(SNAPSHOT_DAYS):
        rows = R.stamp_load_date(R.select_columns(_product_snapshot(spark, sf_dir, version), spec), day)
        if version == 1:
            rows = rows.withColumns({c: F.col(c).cast("string") for c in spec.columns})
        if version == 2:
            rows = rows.withColumn("productid", F.col("productid").cast("int"))
        write_days(rows, spec.name, f"{root}/bronze/{spec.name}")
        silver.refresh(spark, spec, f"{root}/bronze", f"{root}/silver", day)
    return lake.snapshot_scan(spark, spec, f"{root}/silver/products")


@query
def silver_stream_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest version of every order, from a feed in three parts: first versions, corrections with
    late and repeated rows among them, and corrections of some again.
    """
    root = new_folder(spark, "lake")
    columns = _columns(orderid="long", customerid="long", totalamount="double", corrected_on="date")
    spec = TableSpec("corrected_orders", columns, key=("orderid",))
    placed = views.loaded_orders(spark, sf_dir)

    def versions(days: int, factor: int, some: Column) -> DataFrame:
        return placed.where(some).select(
            "orderid",
            "customerid",
            (F.col("totalamount") * factor).alias("totalamount"),
            F.date_add("date", days).alias("corrected_on"),
        )

    n = F.col("orderid")
    first = versions(0, 1, F.lit(True))
    second = versions(10, 2, n % 3 == 0).unionByName(versions(-5, 8, n % 4 == 0)).unionByName(first.where(n % 5 == 0))
    third = versions(20, 4, n % 9 == 0).unionByName(versions(5, 16, n % 2 == 0))
    for part in (first, second, third):
        part.write.mode("append").parquet(f"{root}/feed")
        corrections.keep_latest(
            spark, spec, "corrected_on", f"{root}/feed", f"{root}/silver", f"{root}/progress", PRODUCT_BUCKETS
        ).awaitTermination()
    return spark.read.schema(spec.schema).parquet(*lake.table_paths(spark, f"{root}/silver/{spec.name}"))


def _refresh_in_buckets(spark: SparkSession, sf_dir: str, buckets: int) -> str:
    """The lake of ``silver_refresh``, with the table in buckets of its key."""
    root, spec = new_folder(spark, "lake"), WIDE["products"]
    for version, day in enumerate(SNAPSHOT_DAYS):
        bronze.load(_product_snapshot(spark, sf_dir, version), spec, f"{root}/bronze", day)
        silver.refresh(spark, spec, f"{root}/bronze", f"{root}/silver", day, buckets=buckets)
    return root


@query
def silver_refresh_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table, of which a snapshot rewrites the buckets that its keys are in."""
    root = _refresh_in_buckets(spark, sf_dir, PRODUCT_BUCKETS)
    return lake.snapshot_scan(spark, WIDE["products"], f"{root}/silver/products")


@query
def silver_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "silver")
    latest = silver_latest_by_key(spark, sf_dir)
    for _ in range(2):
        overwrite_table(latest, "lineitem", path)
    return spark.read.schema(latest.schema).parquet(path)


def _months(spark: SparkSession, sf_dir: str) -> tuple[date, date, date, date]:
    """The first month with orders, one in the middle, the one after it, and the last."""
    first, last = (day.replace(day=1) for day in _order_days(spark, sf_dir))
    middle = (first + (last - first) / 2).replace(day=1)
    return first, middle, (middle + timedelta(days=31)).replace(day=1), last


def _book(spark: SparkSession, sf_dir: str, root: str, first: date, last: date) -> None:
    orders = views.monthly_orders(spark, sf_dir)
    bronze.backfill(orders, WIDE["orders"], f"{root}/bronze", first, last)


@query
def silver_incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in monthly loads, every load run twice, are in silver once."""
    root, spec = new_folder(spark, "lake"), WIDE["orders"]
    first, middle, next_month, last = _months(spark, sf_dir)
    for start, end in ((first, middle), (next_month, last)):
        for _ in range(2):
            _book(spark, sf_dir, root, start, end)
            silver.incremental(spark, spec, f"{root}/bronze", f"{root}/silver", start, end)
    return lake.snapshot_scan(spark, spec, f"{root}/silver/orders")


@query
def silver_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New bronze days are picked up once; the last run finds nothing new."""
    root, spec = new_folder(spark, "lake"), WIDE["orders"]
    first, middle, next_month, last = _months(spark, sf_dir)
    for months in ((first, middle), (next_month, last), None):
        if months is not None:
            _book(spark, sf_dir, root, *months)
        order_stream.replace_touched_days(
            spark, spec, f"{root}/bronze", f"{root}/silver", f"{root}/progress"
        ).awaitTermination()
    return lake.snapshot_scan(spark, spec, f"{root}/silver/orders")


@query
def silver_append_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended twice, all orders are in silver twice."""
    root, spec = new_folder(spark, "lake"), WIDE["orders"]
    first, _, _, last = _months(spark, sf_dir)
    _book(spark, sf_dir, root, first, last)
    for _ in range(2):
        silver.incremental(spark, spec, f"{root}/bronze", f"{root}/silver", first, last, "append")
    return lake.snapshot_scan(spark, spec, f"{root}/silver/orders")


@query
def silver_stream_then_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream, a batch load and the stream again on one table: all orders, once."""
    root, spec = new_folder(spark, "lake"), WIDE["orders"]
    first, middle, next_month, last = _months(spark, sf_dir)

    def stream() -> None:
        order_stream.replace_touched_days(
            spark, spec, f"{root}/bronze", f"{root}/silver", f"{root}/progress"
        ).awaitTermination()

    _book(spark, sf_dir, root, first, middle)
    stream()
    _book(spark, sf_dir, root, next_month, last)
    silver.incremental(spark, spec, f"{root}/bronze", f"{root}/silver", next_month, last)
    stream()
    return lake.snapshot_scan(spark, spec, f"{root}/silver/orders")


@query
def silver_stream_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that bronze rewrites between two runs are replaced, not added."""
    root, spec = new_folder(spark, "lake"), WIDE["orders"]
    first, middle, _, last = _months(spark, sf_dir)
    for months in ((first, middle), (middle, last)):
        _book(spark, sf_dir, root, *months)
        order_stream.replace_touched_days(
            spark, spec, f"{root}/bronze", f"{root}/silver", f"{root}/progress"
        ).awaitTermination()
    return lake.snapshot_scan(spark, spec, f"{root}/silver/orders")


# --- KPI states kept by day ------------------------------------------------


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a shop that books once a month, by the month they were shipped in."""
    lines = views.table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_partkey").alias("productid"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd").alias("shipdate"),
    )


def _book_twice(source: DataFrame, wrong: Column, spec: TableSpec, state: DailyState, root: str) -> None:
    """Book two halves of a table's months; the first half's last month is ``wrong`` until it is booked again.

    The state is updated after each booking, and once more for nothing.
    """
    spark = source.sparkSession
    months = source.agg(F.min(spec.day_column), F.max(spec.day_column)).first()
    first, last = (date.fromisoformat(m) for m in months)
    middle = (first + (last - first) / 2).replace(day=1)
    column = spec.columns[-2]
    mistaken = F.when(F.col(spec.day_column) == middle.isoformat(), wrong).otherwise(F.col(column))
    for rows, start, end in (
        (source.withColumn(column, mistaken), first, middle),
        (source, (middle + timedelta(days=31)).replace(day=1), last),
        (source, middle, middle),
    ):
        bronze.backfill(rows, spec, root, start, end)
        state.update(spark, root)
    state.update(spark, root)


@query
def gold_total_orders_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders from bitmaps by month, after a month was booked with wrong ids and again."""
    root = new_folder(spark, "lake")
    spec = TableSpec("bookings", _columns(orderid="long", orderdate="string"), day_column="orderdate")
    state = DailyState("order_ids", spec, DistinctIds("orderid"), f"{root}/state")
    orders = views.monthly_orders(spark, sf_dir).select("orderid", "orderdate")
    _book_twice(orders, F.col("orderid") + 1_000_000_000, spec, state, f"{root}/bronze")
    return daily_state.total_orders(spark, state)


@query
def gold_top5_products_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-selling products from sums by month, after a month was booked with wrong quantities and again."""
    root = new_folder(spark, "lake")
    columns = _columns(productid="long", quantity="long", shipdate="string")
    spec = TableSpec("shipments", columns, day_column="shipdate")
    state = DailyState("units_sold", spec, SumByKey("productid", "quantity"), f"{root}/state")
    _book_twice(_shipments(spark, sf_dir), F.col("quantity") * 1000, spec, state, f"{root}/bronze")
    return K.top_products_sold(daily_state.units_sold(spark, state), views.products(spark, sf_dir))


# --- layouts and audits ----------------------------------------------------


@query
def bronze_orders_laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders by half-year, in files by order id and with Bloom filters of the customer id."""
    root, spec = new_folder(spark, "lake"), WIDE["orders"]
    half = F.trunc(F.add_months(F.trunc("orderdate", "year"), F.when(F.month("orderdate") > 6, 6).otherwise(0)), "month")
    orders = views.orders(spark, sf_dir).withColumn("orderdate", F.date_format(half, "yyyy-MM-dd"))
    first, last = _order_days(spark, sf_dir)
    layout = Layout(sort=("orderid",), bloom=("customerid",))
    bronze.backfill(orders, spec, root, first.replace(month=1, day=1), last, layout=layout)
    return lake.snapshot_scan(spark, spec, f"{root}/orders")


@query
def bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders by month, compacted, with a month booked again afterwards and compacted anew."""
    root, spec = new_folder(spark, "lake"), WIDE["orders"]
    first, middle, _, last = _months(spark, sf_dir)
    _book(spark, sf_dir, root, first, last)
    path = f"{root}/bronze/{spec.name}"
    compaction.compact(spark, spec, path, middle)
    _book(spark, sf_dir, root, middle, middle)
    compaction.compact(spark, spec, path, last)
    return lake.snapshot_scan(spark, spec, path)


@query
def audit_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and silver loads of three parts of all orders; one bronze month changed a cell in between."""
    root, spec = new_folder(spark, "lake"), WIDE["orders"]
    first, middle, next_month, last = _months(spark, sf_dir)
    orders, audits = views.monthly_orders(spark, sf_dir), f"{root}/audits"
    parts = ((first, middle), (next_month, next_month), ((next_month + timedelta(days=31)).replace(day=1), last))
    for start, end in parts:
        bronze.backfill(orders, spec, f"{root}/bronze", start, end, audits_root=audits)
    month = orders.where(F.col("orderdate") == next_month.isoformat())
    one = month.agg(F.min("orderid")).first()[0]
    changed = month.withColumn("totalamount", F.col("totalamount") + (F.col("orderid") == one).cast("int"))
    bronze.backfill(changed, spec, f"{root}/bronze", next_month, next_month)
    for start, end in parts:
        silver.incremental(spark, spec, f"{root}/bronze", f"{root}/silver", start, end, audits_root=audits)
    return audit.audited(spark, audits).select("bronze_rows", "silver_rows", "same")


# --- history ---------------------------------------------------------------


def _snapshot(spark: SparkSession, sf_dir: str, table: str, version: int) -> DataFrame:
    """A table as of snapshot 0, 1, 2: customers move and are renamed, products are restocked,
    items are shipped, and those shipped before are corrected.
    """
    if table == "products":
        return _product_snapshot(spark, sf_dir, version)
    if table == "orderitems":
        shipped = views.table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit(HISTORY_DAYS[version]))
        return views.orderitems_of(shipped).withColumn("quantity", F.col("quantity") + version)
    customers = views.customers(spark, sf_dir)
    if version == 0:
        customers = customers.where(F.col("customerid") % 3 != 0)
    if version == 1:
        customers = customers.where(F.col("customerid") % 5 != 0)
    renamed = F.col("customerid") % 2 == 0
    return customers.withColumn(
        "lastname", F.when(renamed, F.concat("lastname", F.lit(f"-{version}"))).otherwise(F.col("lastname"))
    )


def _histories(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """A lake with three snapshots of each table, and their histories brought up to date after each."""
    root = new_folder(spark, "lake")
    for version, day in enumerate(HISTORY_DAYS):
        for name in tables:
            bronze.load(_snapshot(spark, sf_dir, name, version), WIDE[name], f"{root}/bronze", day)
            history.refresh(spark, WIDE[name], f"{root}/bronze", f"{root}/history")
    return root


def _lake_as_of(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    """The whole lake, and its tables as they were between the second snapshot and the third."""
    root, spec = _histories(spark, sf_dir, "customers", "products", "orderitems"), WIDE["orders"]
    first, _, _, last = _months(spark, sf_dir)
    _book(spark, sf_dir, root, first, last)
    silver.incremental(spark, spec, f"{root}/bronze", f"{root}/silver", first, last)
    return root, history.tables_as_of(spark, WIDE, f"{root}/silver", f"{root}/history", AS_OF_DAY)


@query
def gold_kpis_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a past day, after customers, products and items changed again."""
    root, tables = _lake_as_of(spark, sf_dir)
    gold.build(tables, f"{root}/gold", AS_OF_DAY)
    return report.long_report(spark, f"{root}/gold", AS_OF_DAY)


@query
def gold_top5_orders_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most valuable orders of a past day, with the names that customers had on it."""
    _, tables = _lake_as_of(spark, sf_dir)
    return gold.kpis(tables)["top_5_orders_value"]


@query
def silver_customers_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as a full load on a past day left them."""
    root = _histories(spark, sf_dir, "customers")
    return history.table_as_of(spark, WIDE["customers"], f"{root}/history", AS_OF_DAY)


@query
def history_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validity of every version of every customer."""
    root = _histories(spark, sf_dir, "customers")
    rows = history.history_scan(spark, WIDE["customers"], f"{root}/history")
    return rows.select("customerid", "lastname", "valid_from", "last_seen", "valid_to", "copies")


@query
def orders_with_customer_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the name that its customer had on the order's day."""
    root = _histories(spark, sf_dir, "customers")
    customers = history.history_scan(spark, WIDE["customers"], f"{root}/history")
    orders = views.loaded_orders(spark, sf_dir).select("orderid", "customerid", "date")
    names = customers.drop("firstname", "email", "phone")
    return as_of_join(orders, names, "customerid", "date")


# --- gold and report -------------------------------------------------------


@query
def gold_total_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.total_orders(views.loaded_orders(spark, sf_dir))


@query
def gold_total_orders_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same KPI without what was loaded after a given day."""
    return K.total_orders(gold.loaded_by(views.loaded_orders(spark, sf_dir), AS_OF_DAY))


@query
def gold_top5_orders_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.top_orders_by_value(views.orders(spark, sf_dir), views.customers(spark, sf_dir))


@query
def gold_top5_orders_of_many_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with a cut before the join."""
    orders, customers = views.orders(spark, sf_dir), views.customers(spark, sf_dir)
    return K.top_orders_by_value(orders, customers, many_customers=True)


@query
def gold_top5_products_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.top_products_sold(views.orderitems(spark, sf_dir), views.products(spark, sf_dir))


@query
def gold_low_stock_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.low_stock_products(views.products(spark, sf_dir))


def _build_gold(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """Gold with the named KPIs, or all of them."""
    tables = views.sales_tables(spark, sf_dir)
    tables["orders"] = views.loaded_orders(spark, sf_dir)
    root = new_folder(spark, "gold")
    frames = gold.kpis(tables)
    gold.write_kpis({name: frames[name] for name in names or frames}, root, RUN_DATE)
    return root


@query
def gold_kpi_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _build_gold(spark, sf_dir, "top_5_products_sold")
    return lake.kpi_scan(spark, root, RUN_DATE, "top_5_products_sold")


@query
def kpi_missing_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a run whose order total was never written."""
    written = [name for name in KPIS if name != "total_orders"]
    return report.long_report(spark, _build_gold(spark, sf_dir, *written), RUN_DATE)


@query
def report_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.headline(spark, _build_gold(spark, sf_dir, "total_orders"), RUN_DATE)


@query
def report_orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.orders_table(spark, _build_gold(spark, sf_dir, "top_5_orders_value"), RUN_DATE)


@query
def report_products_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.products_series(spark, _build_gold(spark, sf_dir, "top_5_products_sold"), RUN_DATE)


@query
def report_stock_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.stock_series(spark, _build_gold(spark, sf_dir, "low_stock_products"), RUN_DATE)


@query
def kpi_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.long_report(spark, _build_gold(spark, sf_dir), RUN_DATE)


@query
def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: all orders so far, then a day with new stock and no new orders."""
    root = new_folder(spark, "lake")
    first, last = _order_days(spark, sf_dir)
    sources = views.sales_tables(spark, sf_dir)
    medallion.run(spark, sources, root, last, WIDE, backfill_from=first)
    next_day = last + timedelta(days=1)
    sources |= {"products": _product_snapshot(spark, sf_dir, 1)}
    medallion.run(spark, sources, root, next_day, WIDE)
    return report.long_report(spark, f"{root}/gold", next_day)
