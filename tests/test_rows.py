"""Projection, casts, stamps, day filters, masks and scalar expressions."""

from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidelake.functions import columns as C
from tidelake.operators.rows import (
    mask_columns,
    on_run_date,
    on_run_dates,
    select_columns,
    stabilize_types,
    stamp_load_date,
)
from tidelake.specs import SALES, wide_sales

ORDERS = SALES["orders"]
TEXT_ORDERS = "orderid STRING, customerid STRING, orderdate STRING, totalamount STRING"


def test_select_drops_other_columns(spark):
    df = spark.createDataFrame([(1, "x", "A", "B", "e", "p")], "customerid INT, extra STRING, "
                               "firstname STRING, lastname STRING, email STRING, phone STRING")
    assert select_columns(df, SALES["customers"]).columns == SALES["customers"].columns


def test_stabilize_casts_to_declared_types(spark):
    df = spark.createDataFrame([("1", "2", "2025-01-01", "12.5")], TEXT_ORDERS)
    assert stabilize_types(df, ORDERS).dtypes == [
        ("orderid", "int"), ("customerid", "int"), ("orderdate", "string"), ("totalamount", "double"),
    ]
    assert stabilize_types(df, wide_sales()["orders"]).dtypes[0] == ("orderid", "bigint")


def test_stabilize_strict_raises_lenient_gives_null(spark):
    df = spark.createDataFrame([("1", "2", "2025-01-01", "abc")], TEXT_ORDERS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stabilize_types(df, ORDERS).collect()
    assert stabilize_types(df, ORDERS, lenient=True).first().totalamount is None


def test_stabilize_leaves_right_types_alone(spark):
    df = spark.createDataFrame([(1, 2, "d", 1.0)], ORDERS.schema)
    plan = stabilize_types(df, ORDERS)._jdf.queryExecution().optimizedPlan().toString()
    assert "cast" not in plan


def test_stamp(spark):
    df = stamp_load_date(spark.range(2), date(2025, 1, 1))
    assert df.dtypes[-1] == ("date", "date")
    assert {r.date for r in df.collect()} == {date(2025, 1, 1)}


@pytest.fixture
def dated(spark):
    days = ["2025-01-01", "2025-01-01 10:00:00", "2025-01-02", "2025-02-30", "2025-1-3", None]
    return spark.createDataFrame([(i, 1, day, 1.0) for i, day in enumerate(days)], ORDERS.schema)


def test_run_date_is_exact_text(dated):
    assert [r.orderid for r in on_run_date(dated, ORDERS, date(2025, 1, 1)).collect()] == [0]


def test_run_dates_is_the_union_of_single_runs(dated):
    rows = on_run_dates(dated, ORDERS, date(2025, 1, 1), date(2025, 12, 31)).collect()
    assert [(r.orderid, r.date) for r in rows] == [(0, date(2025, 1, 1)), (2, date(2025, 1, 2))]


def test_mask_covers_the_header_row(spark):
    df = spark.createDataFrame([("id", "name"), ("1", None)], "_c0 STRING, _c1 STRING")
    assert [tuple(r) for r in mask_columns(df, "_c1").collect()] == [("id", "****"), ("1", "****")]


def test_line_expressions(spark):
    df = spark.range(2).select(C.numbered_line(F.col("id")).alias("line"))
    done = df.select(C.with_done_suffix(F.col("line")).alias("line"))
    assert [r.line for r in done.collect()] == [
        "Arquivo texto linha 0 - Processado com sucesso!",
        "Arquivo texto linha 1 - Processado com sucesso!",
    ]


def test_without_tags(spark):
    df = spark.createDataFrame([("<p class='a'>x</p><br/>y <> z",)], "html STRING")
    assert df.select(C.without_tags(F.col("html")).alias("t")).first().t == "xy <> z"


def night(spark, now, sunrise="06:00:00+00:00", sunset="18:00:00+00:00", **kwargs):
    body = '{"results": {"sunrise": "2025-01-01T%s", "sunset": "2025-01-01T%s"}}' % (sunrise, sunset)
    df = spark.createDataFrame([(body, now)], "body STRING, now TIMESTAMP_NTZ")
    return df.select(C.payload_is_night(F.col("body"), F.col("now"), **kwargs).alias("n")).first().n


@pytest.mark.parametrize(
    "hour, expected", [(12, False), (0, True), (6, True), (18, True), (7, False), (19, True)]
)
def test_day_and_night_bounds_are_strict(spark, hour, expected):
    assert night(spark, datetime(2025, 1, 1, hour)) is expected


def test_offset_is_cut_off_unless_applied(spark):
    noon = datetime(2025, 1, 1, 17)
    assert night(spark, noon, sunset="18:00:00+02:00") is False
    assert night(spark, noon, sunset="18:00:00+02:00", apply_offset=True) is True


def test_day_and_night_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert night(spark, datetime(2025, 1, 1, 7)) is False
        now = spark.range(1).select(C.utc_now().alias("now")).first().now
        assert abs((now - datetime.now(UTC).replace(tzinfo=None)).total_seconds()) < 60
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_malformed_payload_time_raises(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        night(spark, datetime(2025, 1, 1), sunrise="late+00:00")
