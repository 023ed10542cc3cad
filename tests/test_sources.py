"""SQLite and JDBC scans, text, CSV and JSON files."""

import os
import sqlite3
from contextlib import closing

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringContains

from tidelake.functions import columns as C
from tidelake.operators.rows import mask_columns, stabilize_types
from tidelake.sinks.files import write_lines, write_positional_csv
from tidelake.sources import files, jdbc
from tidelake.sources.sqlite import (
    SQLiteReader,
    key_ranges,
    sqlite_scan,
    superset_condition,
    write_sqlite_shards,
)
from tidelake.specs import SALES

ORDERS = SALES["orders"]


@pytest.fixture
def database(tmp_path):
    """Orders with odd values, in one SQLite file."""
    path = str(tmp_path / "sales.db")
    with closing(sqlite3.connect(path)) as connection, connection:
        connection.execute(
            "CREATE TABLE orders (orderid INTEGER, customerid INTEGER, orderdate TEXT, "
            "totalamount REAL, note TEXT)"
        )
        connection.executemany(
            "INSERT INTO orders VALUES (?, ?, ?, ?, 'x')",
            [(i, i % 7, "2025-01-%02d" % (i % 3 + 1), i / 2) for i in range(1, 101)]
            + [(None, 1, "2025-01-01", 1.0), (200, None, "2025-01-01 10:00:00", None)],
        )
        connection.execute("CREATE TABLE mixed (v)")
        connection.executemany("INSERT INTO mixed VALUES (?)", [(5,), ("5",), (6,), (None,)])
    return path


def test_query_and_table_scans(spark, database):
    query = sqlite_scan(spark, database, "orders", query=ORDERS.query, schema=ORDERS.schema)
    assert query.dtypes == [(f.name, f.dataType.simpleString()) for f in ORDERS.schema.fields]
    assert query.count() == 102
    table = sqlite_scan(spark, database, "orders")
    assert table.columns == [*ORDERS.columns, "note"]
    assert {t for _, t in table.dtypes} == {"string"}
    assert sorted(map(str, stabilize_types(table, ORDERS).select(*ORDERS.columns).collect())) == sorted(
        map(str, query.collect())
    )


@pytest.mark.parametrize("column", ["orderid", "customerid"])
@pytest.mark.parametrize("parts", [2, 7, 300])
def test_key_ranges_cover_every_row_once(spark, database, column, parts):
    split = sqlite_scan(
        spark, database, "orders", ORDERS.query, ORDERS.schema, column, num_partitions=parts
    )
    assert split.rdd.getNumPartitions() > 1
    whole = sqlite_scan(spark, database, "orders", ORDERS.query, ORDERS.schema)
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))


def test_rowid_splits_a_bare_table(spark, database):
    df = sqlite_scan(spark, database, "orders", None, ORDERS.schema, "rowid", num_partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 102


def test_key_range_texts():
    assert key_ranges("k", 1, 1, 4) == [
        ("([k] < ? OR [k] IS NULL)", (1,)),
        ("[k] >= ?", (1,)),
    ]


def test_filters_reach_sqlite():
    reader = SQLiteReader(ORDERS.schema, {"path": "/x.db", "table": "orders"})
    kept = list(reader.pushFilters([EqualTo(("orderdate",), "2025-01-01"), In(("orderid",), (1, 2)),
                                    StringContains(("orderdate",), "2025")]))
    assert len(kept) == 3, "Spark applies every filter again"
    assert [arguments for _, arguments in reader.filters] == [("2025-01-01",), (1, 2)]


def test_pushed_filter_reads_only_matching_rows(database):
    reader = SQLiteReader(ORDERS.schema, {"path": database, "table": "orders"})
    list(reader.pushFilters([EqualTo(("orderdate",), "2025-01-01")]))
    rows = sum(batch.num_rows for part in reader.partitions() for batch in reader.read(part))
    assert rows == 34


def test_pushed_filter_never_drops_a_value_stored_as_another_type(spark, database):
    schema = "v INT"
    df = sqlite_scan(spark, database, "mixed", schema=spark.createDataFrame([], schema).schema)
    assert sorted(r.v for r in df.where("v = 5").collect()) == [5, 5]
    text = sqlite_scan(spark, database, "mixed")
    assert sorted(r.v for r in text.where("v = '5'").collect()) == ["5", "5"]


def test_conditions_for_unknown_columns_are_not_pushed():
    assert superset_condition(GreaterThan(("a", "b"), 1), {}) is None
    assert superset_condition(GreaterThan(("a",), 1), {}) is None


def test_malformed_value_raises(spark, tmp_path):
    path = str(tmp_path / "bad.db")
    with closing(sqlite3.connect(path)) as connection, connection:
        connection.execute("CREATE TABLE t (v)")
        connection.execute("INSERT INTO t VALUES ('abc')")
    schema = spark.createDataFrame([], "v INT").schema
    with pytest.raises(Exception, match="abc"):
        sqlite_scan(spark, path, "t", schema=schema).collect()


def test_shards_hold_all_rows_in_one_file_per_task(spark, tmp_path):
    path = str(tmp_path / "shards")
    df = spark.range(0, 1000, 1, 4).selectExpr("id AS orderid", "CAST(NULL AS STRING) AS note")
    write_sqlite_shards(df, path, "orders")
    assert len(os.listdir(path)) == 4
    back = sqlite_scan(spark, path, "orders", schema=df.schema)
    assert back.agg(F.count("*"), F.sum("orderid"), F.count("note")).first()[:] == (1000, 499500, 0)
    open(os.path.join(path, "part-dead.pending"), "w").close()
    assert back.count() == 1000, "files of unfinished tasks are not read"


def test_sqlite_needs_a_file_path(spark):
    with pytest.raises(Exception, match="file path"):
        sqlite_scan(spark, "hdfs://host/x.db", "orders", schema=ORDERS.schema).collect()


class RecordingReader:
    """Stands in for ``spark.read``: no database is opened."""

    def __init__(self, bounds):
        self.bounds, self.calls = bounds, []

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return self.bounds


def test_jdbc_relation_and_options():
    assert jdbc.relation("orders", "SELECT 1") == "(SELECT 1) AS tmp"
    assert jdbc.relation("orders", "") == "orders"
    spark = RecordingReader((1, 900))
    jdbc.jdbc_scan(
        spark, jdbc.sqlite_options("/data/x.db"), "orders", ORDERS.query,
        partition_column="orderid", num_partitions=9,
    )
    bounds, scan = spark.calls
    assert scan["url"] == "jdbc:sqlite:/data/x.db" and scan["driver"] == "org.sqlite.JDBC"
    assert bounds["dbtable"] == (
        f"(SELECT MIN(orderid) AS lo, MAX(orderid) AS hi FROM ({ORDERS.query}) AS tmp) AS tmp"
    )
    assert scan["dbtable"] == f"({ORDERS.query}) AS tmp"
    assert (scan["lowerBound"], scan["upperBound"], scan["numPartitions"]) == ("1", "900", "9")


def test_jdbc_without_rows_or_partitions_is_one_scan():
    for bounds, parts in (((None, None), 4), ((1, 2), 1)):
        spark = RecordingReader(bounds)
        jdbc.jdbc_scan(spark, {}, "orders", partition_column="orderid", num_partitions=parts)
        assert "partitionColumn" not in spark.calls[-1]
        assert spark.calls[-1]["dbtable"] == "orders"


HEADED = '''id,produto,quantidade,preco
1,Camiseta,10,25.0
2,"Calça, azul",5,50.0
3,"Meias ""finas""",20,10.0
4,Boné,15,15.0
5,Camiseta,10,25.0
6,Calça,5,50.0
7,Meias,20,10.0
8,Boné,,15.0
'''


def test_headerless_csv_and_mask(spark, tmp_path):
    source, target = tmp_path / "in.csv", str(tmp_path / "out")
    source.write_text(HEADED, encoding="utf-8")
    df = files.read_headerless_csv(spark, str(source), columns=4)
    rows = df.collect()
    assert (len(rows), len(df.columns)) == (9, 4)
    assert rows[2]._c1 == "Calça, azul" and rows[3]._c1 == 'Meias "finas"'
    assert rows[8]._c2 is None
    masked = mask_columns(df, "_c2")
    assert {r._c2 for r in masked.collect()} == {"****"}
    write_positional_csv(masked, target)
    back = spark.read.csv(target, header=True, **files.CSV_QUOTING)
    assert back.columns == ["0", "1", "2", "3"]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, masked.collect()))


def test_missing_cells_are_null_and_written_empty(spark, tmp_path):
    source, target = tmp_path / "in.csv", str(tmp_path / "out")
    source.write_text('a,NA,null\n"",x,n/a\n\nNone,Nonesuch,0\n')
    df = files.read_headerless_csv(spark, str(source), columns=3)
    assert sorted(map(str, map(tuple, df.collect()))) == [
        "('a', None, None)", "(None, 'Nonesuch', '0')", "(None, 'x', None)",
    ]
    write_positional_csv(df, target)
    lines = spark.read.text(target).collect()
    assert {r.value for r in lines} == {"0,1,2", "a,,", ",x,", ",Nonesuch,0"}


def test_multi_line_cells(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('1,"two\nlines"\n2,one\n')
    df = files.read_headerless_csv(spark, str(source), columns=2, multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("1", "two\nlines"), ("2", "one")]


def test_line_roundtrip(spark, folder):
    write_lines(files.generate_lines(spark, 10), f"{folder}/in")
    done = files.read_lines(spark, f"{folder}/in").select(C.with_done_suffix(F.col("value")).alias("value"))
    write_lines(done, f"{folder}/out")
    assert sorted(r.value for r in files.read_lines(spark, f"{folder}/out").collect()) == [
        f"Arquivo texto linha {i} - Processado com sucesso!" for i in range(10)
    ]


def test_payload_files(spark, tmp_path):
    file = tmp_path / "p.json"
    file.write_text(
        '{"results": {"sunrise": "2025-01-01T06:00:00+00:00", "sunset": "2025-01-01T18:00:00+00:00"}}\n'
    )
    row = files.read_payloads(spark, str(file)).first()
    assert row.results.sunrise == "2025-01-01T06:00:00+00:00"
    file.write_text("not json\n")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_payloads(spark, str(file)).collect()
