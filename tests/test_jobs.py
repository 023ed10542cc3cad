"""The command line, from a SQLite file to the report."""

import sqlite3
from contextlib import closing

import pytest

from tidelake.jobs import main
from tidelake.sources.lake import table_path, table_paths


@pytest.fixture
def database(tmp_path):
    path = str(tmp_path / "sales.db")
    with closing(sqlite3.connect(path)) as connection, connection:
        connection.executescript(
            """
            CREATE TABLE customers (customerid INTEGER, firstname TEXT, lastname TEXT, email TEXT,
                                    phone TEXT);
            CREATE TABLE products (productid INTEGER, productname TEXT, price REAL, stockquantity INTEGER);
            CREATE TABLE orderitems (orderitemid INTEGER, orderid INTEGER, productid INTEGER,
                                     quantity INTEGER, itemprice REAL);
            CREATE TABLE orders (orderid TEXT, customerid TEXT, orderdate TEXT, totalamount TEXT);
            CREATE TABLE shops (shopid INTEGER, city TEXT);
            INSERT INTO customers VALUES (1, 'Ana', 'Lima', 'a@example.com', '1');
            INSERT INTO products VALUES (1, 'pen', 1.5, 7), (2, 'cup', 4.0, 3);
            INSERT INTO orderitems VALUES (1, 1, 1, 4, 1.5), (2, 1, 2, 6, 4.0);
            INSERT INTO orders VALUES ('1', '1', '2025-01-01', '30.5'), ('2', '1', '2025-01-02', '9'),
                                      ('3', '1', '2025-01-03', 'n/a');
            INSERT INTO shops VALUES (1, 'Recife'), (2, 'Natal');
            """
        )
    return path


def test_layer_by_layer(spark, database, folder, capsys):
    day = ["--lake", folder, "--ds_date", "2025-01-01"]
    for table in ("customers", "products", "orderitems", "orders"):
        main(["bronze", "--database", database, "--table", table, *day])
        main(["silver", "--table", table, *day])
    main(["gold", *day])
    capsys.readouterr()
    main(["report", *day])
    shown = capsys.readouterr().out
    assert "|top_5_orders_value |1       |1    |30.5 |" in shown
    assert "|low_stock_products |1       |cup  |3.0  |" in shown
    main(["preview", "--table", "customers", *day])
    assert "Ana" in capsys.readouterr().out


def test_run_all(spark, database, folder, capsys):
    main(["run", "--database", database, "--lake", folder, "--ds_date", "2025-01-02", "--wide"])
    main(["report", "--lake", folder, "--ds_date", "2025-01-02"])
    assert "|top_5_orders_value |1       |2    |9.0  |" in capsys.readouterr().out


def test_a_table_outside_the_catalogue(spark, database, folder):
    for day in ("2025-01-01", "2025-01-02"):
        main(["bronze", "--database", database, "--table", "shops", "--lake", folder, "--ds_date", day,
              "--query", "SELECT shopid, city FROM shops", "--write_mode", "append"])
    main(["silver", "--table", "shops", "--lake", folder, "--primary_key", "shopid"])
    rows = spark.read.parquet(table_path(spark, f"{folder}/silver/shops")).orderBy("shopid").collect()
    assert [(r.shopid, r.city, str(r.date)) for r in rows] == [
        ("1", "Recife", "2025-01-02"), ("2", "Natal", "2025-01-02"),
    ]
    with pytest.raises(ValueError, match="primary key"):
        main(["silver", "--table", "shops", "--lake", folder])


def test_malformed_values(spark, database, folder):
    load = ["bronze", "--database", database, "--table", "orders", "--lake", folder,
            "--ds_date", "2025-01-03"]
    with pytest.raises(Exception, match="n/a"):
        main(load)
    main([*load, "--lenient"])
    row = spark.read.parquet(f"{folder}/bronze/orders").first()
    assert (row.orderid, row.totalamount) == (3, None)


def test_backfill_stream_and_as_of(spark, database, folder):
    lake = ["--lake", folder]
    main(["backfill", "--database", database, "--table", "orders", *lake, "--from", "2025-01-01",
          "--ds_date", "2025-01-02"])
    main(["stream", "--table", "orders", *lake, "--progress", f"{folder}/progress"])
    assert spark.read.parquet(f"{folder}/silver/orders").count() == 2
    main(["silver", "--table", "orders", *lake, "--ds_date", "2025-01-01", "--write_mode", "append"])
    assert spark.read.parquet(f"{folder}/silver/orders").count() == 3
    with pytest.raises(FileNotFoundError, match="customers"):
        main(["gold", *lake, "--ds_date", "2025-01-02"])
    for table in ("customers", "products", "orderitems"):
        main(["bronze", "--database", database, "--table", table, *lake, "--ds_date", "2025-01-01",
              "--num_partitions", "2"])
        main(["silver", "--table", table, *lake, "--refresh", "--ds_date", "2025-01-01"])
    main(["gold", *lake, "--ds_date", "2025-01-02", "--as_of", "2025-01-01"])
    main(["report", *lake, "--ds_date", "2025-01-02"])
    stored = spark.read.parquet(f"{folder}/report/date=2025-01-02")
    assert [r.value for r in stored.where("kpi = 'total_orders'").collect()] == [1.0]


def test_keys_and_modes_are_honoured_or_refused(spark, database, folder):
    day = ["--lake", folder, "--ds_date", "2025-01-01"]
    main(["bronze", "--database", database, "--table", "products", *day])
    main(["silver", "--table", "products", "--lake", folder, "--primary_key", "productid", "--primary_key", "price"])
    assert spark.read.parquet(table_path(spark, f"{folder}/silver/products")).count() == 2
    for flags in (["--table", "products", "--is_incremental"], ["--table", "products", "--write_mode", "append"],
                  ["--table", "orders", "--primary_key", "orderid"]):
        with pytest.raises(SystemExit):
            main(["silver", *flags, *day])


def test_rejects_history_and_errors(spark, database, folder, capsys):
    lake = ["--lake", folder]
    for table in ("customers", "products", "orderitems"):
        main(["bronze", "--database", database, "--table", table, *lake, "--ds_date", "2025-01-01", "--rejects"])
        main(["silver", "--table", table, *lake, "--refresh", "--ds_date", "2025-01-01", "--buckets", "4"])
        main(["history", "--table", table, *lake])
    assert "rows_rejected=0" in capsys.readouterr().out
    assert spark.read.parquet(*table_paths(spark, f"{folder}/silver/products")).count() == 2
    with pytest.raises(SystemExit):
        main(["bronze", "--database", database, "--table", "products", *lake, "--ds_date", "2025-01-01", "--rejects",
              "--write_mode", "append"])
    with open(f"{folder}/bronze/products/date=2025-01-01/part-cut.parquet".removeprefix("file:"), "w") as file:
        file.write("PAR1")
    main(["errors", "--table", "products", *lake])
    assert "part-cut.parquet" in capsys.readouterr().out
