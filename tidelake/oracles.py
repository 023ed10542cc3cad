"""DuckDB SQL for the queries of ``tidelake.queries``, over the same tables."""

from __future__ import annotations

DAY = "strftime(o_orderdate, '%Y-%m-%d')"
ORDER_COLUMNS = (
    f"o_orderkey AS orderid, o_custkey AS customerid, {DAY} AS orderdate, "
    "o_totalprice AS totalamount"
)
CUSTOMER_COLUMNS = (
    "c_custkey AS customerid, split_part(c_name, '#', 1) AS firstname, "
    "split_part(c_name, '#', 2) AS lastname, "
    "'c' || c_custkey || '@example.com' AS email, "
    "c_nationkey || '-' || c_custkey AS phone"
)
PRODUCT_COLUMNS = "p_partkey AS productid, p_name AS productname, p_retailprice AS price"

LOADED_ORDERS = f"SELECT {ORDER_COLUMNS}, CAST(o_orderdate AS DATE) AS date FROM orders"
MONTHLY_ORDERS = """
    SELECT o_orderkey AS orderid, o_custkey AS customerid,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS orderdate,
           o_totalprice AS totalamount,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS date
    FROM orders
"""
ONE_DAY = f"{LOADED_ORDERS} WHERE {DAY} = '1995-06-19'"
CUSTOMER_SNAPSHOT = f"SELECT {CUSTOMER_COLUMNS}, DATE '2025-01-01' AS date FROM customer"
LATEST_PRODUCTS = f"""
    SELECT {PRODUCT_COLUMNS},
           CAST(p_size + CASE WHEN p_size <= 10 THEN 2 WHEN p_size <= 25 THEN 1 ELSE 0 END
                AS BIGINT) AS stockquantity,
           CASE WHEN p_size <= 10 THEN DATE '2025-01-03'
                WHEN p_size <= 25 THEN DATE '2025-01-02'
                ELSE DATE '2025-01-01' END AS date
    FROM part
"""
LATEST_LINES = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate
    FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_shipdate DESC NULLS LAST) AS r
          FROM lineitem)
    WHERE r = 1
"""
LINES = "SELECT 'Arquivo texto linha ' || o_orderkey AS value FROM orders"
TOP_ORDERS = f"""
    SELECT o_orderkey AS orderid, split_part(c_name, '#', 1) AS firstname,
           split_part(c_name, '#', 2) AS lastname, o_totalprice AS totalamount,
           {DAY} AS orderdate
    FROM orders JOIN customer ON o_custkey = c_custkey
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 5
"""
TOP_PRODUCTS = """
    SELECT p_name AS productname, CAST(sum(l_quantity) AS BIGINT) AS total_sold
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_name ORDER BY total_sold DESC NULLS LAST, productname LIMIT 5
"""
LOW_STOCK = """
    SELECT p_name AS productname, CAST({stock} AS BIGINT) AS stockquantity
    FROM part ORDER BY stockquantity ASC NULLS FIRST, p_partkey LIMIT 5
"""


def _report(total: str, stock: str, top_orders: str = TOP_ORDERS, top_products: str = TOP_PRODUCTS) -> str:
    return f"""
        SELECT 'total_orders' AS kpi, 1 AS position, CAST(NULL AS VARCHAR) AS label,
               CAST({total} AS DOUBLE) AS value
        UNION ALL
        SELECT 'top_5_orders_value',
               CAST(row_number() OVER (ORDER BY totalamount DESC NULLS LAST, orderid) AS INTEGER),
               CAST(orderid AS VARCHAR), totalamount
        FROM ({top_orders})
        UNION ALL
        SELECT 'top_5_products_sold',
               CAST(row_number() OVER (ORDER BY total_sold DESC NULLS LAST, productname) AS INTEGER),
               productname, CAST(total_sold AS DOUBLE)
        FROM ({top_products})
        UNION ALL
        SELECT 'low_stock_products',
               CAST(row_number() OVER (ORDER BY stockquantity ASC NULLS FIRST, productname)
                    AS INTEGER),
               productname, CAST(stockquantity AS DOUBLE)
        FROM ({LOW_STOCK.format(stock=stock)})
    """


COUNT_ORDERS = "(SELECT count(DISTINCT o_orderkey) FROM orders)"
STOCK_AFTER_DAY_2 = "p_size + CASE WHEN p_size <= 25 THEN 1 ELSE 0 END"

# Three snapshots of customers, and which of them each is in.
HISTORY_CUSTOMERS = """
    SELECT c_custkey AS customerid, day AS date, version,
           split_part(c_name, '#', 1) AS firstname,
           split_part(c_name, '#', 2) || CASE WHEN c_custkey % 2 = 0 THEN '-' || version ELSE '' END AS lastname,
           'c' || c_custkey || '@example.com' AS email, c_nationkey || '-' || c_custkey AS phone
    FROM customer, (VALUES (0, DATE '1994-06-30'), (1, DATE '1996-06-30'), (2, DATE '1998-03-31')) s(version, day)
    WHERE NOT (version = 0 AND c_custkey % 3 = 0) AND NOT (version = 1 AND c_custkey % 5 = 0)
"""
CUSTOMERS_AS_OF = f"""
    SELECT customerid, firstname, lastname, email, phone, date FROM ({HISTORY_CUSTOMERS})
    WHERE date <= DATE '1997-07-15'
    QUALIFY rank() OVER (PARTITION BY customerid ORDER BY date DESC) = 1
"""
MONTH = "date_trunc('month', o_orderdate)"
TOP_ORDERS_AS_OF = f"""
    SELECT o_orderkey AS orderid, firstname, lastname, o_totalprice AS totalamount,
           strftime({MONTH}, '%Y-%m-%d') AS orderdate
    FROM orders JOIN ({CUSTOMERS_AS_OF}) ON o_custkey = customerid
    WHERE {MONTH} <= DATE '1997-07-15'
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 5
"""
ITEMS_AS_OF = """
    SELECT l_partkey, l_quantity + 1 AS l_quantity FROM lineitem WHERE l_shipdate <= TIMESTAMP '1996-06-30'
"""
TOP_PRODUCTS_AS_OF = f"""
    SELECT p_name AS productname, CAST(sum(l_quantity) AS BIGINT) AS total_sold
    FROM ({ITEMS_AS_OF}) JOIN part ON l_partkey = p_partkey
    GROUP BY p_name ORDER BY total_sold DESC NULLS LAST, productname LIMIT 5
"""
HALF_YEAR_ORDERS = """
    SELECT o_orderkey AS orderid, o_custkey AS customerid, strftime(half, '%Y-%m-%d') AS orderdate,
           o_totalprice AS totalamount, CAST(half AS DATE) AS date
    FROM (SELECT *, date_trunc('year', o_orderdate)
                    + CASE WHEN month(o_orderdate) > 6 THEN INTERVAL 6 MONTH ELSE INTERVAL 0 MONTH END AS half
          FROM orders)
"""
ORDERS_AS_OF = f"(SELECT count(DISTINCT o_orderkey) FROM orders WHERE {MONTH} <= DATE '1997-07-15')"

ORACLES: dict[str, str] = {
    "source_query_scan": f"SELECT {ORDER_COLUMNS} FROM orders",
    "source_table_scan": f"SELECT {CUSTOMER_COLUMNS} FROM customer",
    "snapshot_scan": f"""
        SELECT {PRODUCT_COLUMNS}, CAST(p_size AS BIGINT) AS stockquantity,
               DATE '2025-01-01' AS date FROM part
        UNION ALL
        SELECT {PRODUCT_COLUMNS}, CAST(p_size + 1 AS BIGINT), DATE '2025-01-02'
        FROM part WHERE p_size <= 25
        UNION ALL
        SELECT {PRODUCT_COLUMNS}, CAST(p_size + 2 AS BIGINT), DATE '2025-01-03'
        FROM part WHERE p_size <= 10
    """,
    "partition_scan": f"""
        SELECT {PRODUCT_COLUMNS}, CAST(p_size + 1 AS BIGINT) AS stockquantity,
               DATE '2025-01-02' AS date
        FROM part WHERE p_size <= 25
    """,
    "partition_preview": f"{CUSTOMER_SNAPSHOT} ORDER BY customerid LIMIT 5",
    "generate_lines": LINES,
    "text_line_roundtrip": """
        SELECT value || ' - Processado com sucesso!' AS value
        FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)
    """,
    "csv_headerless_mask": """
        SELECT 'c_custkey' AS c0, 'c_mktsegment' AS c1, '****' AS c2
        UNION ALL
        SELECT CAST(c_custkey AS VARCHAR), c_mktsegment, '****' FROM customer
    """,
    "json_payload_scan": """
        SELECT strftime(ts, '%Y-%m-%d') || 'T06:00:00+00:00' AS sunrise,
               strftime(ts, '%Y-%m-%d') || 'T18:00:00+00:00' AS sunset
        FROM events
    """,
    "is_night": """
        SELECT event_id,
               NOT (date_trunc('day', ts) + INTERVAL 6 HOUR < ts
                    AND ts < date_trunc('day', ts) + INTERVAL 18 HOUR) AS is_night
        FROM events
    """,
    "bronze_select_customers": f"SELECT {CUSTOMER_COLUMNS} FROM customer",
    "bronze_select_products": f"""
        SELECT {PRODUCT_COLUMNS}, CAST(p_size AS BIGINT) AS stockquantity FROM part
    """,
    "bronze_select_orderitems": """
        SELECT l_orderkey * 10 + l_linenumber AS orderitemid, l_orderkey AS orderid,
               l_partkey AS productid, CAST(l_quantity AS BIGINT) AS quantity,
               l_extendedprice AS itemprice
        FROM lineitem
    """,
    "bronze_select_orders": f"SELECT {ORDER_COLUMNS} FROM orders",
    "stabilize_types": f"""
        SELECT TRY_CAST(o_orderkey AS INTEGER) AS orderid,
               TRY_CAST(o_custkey AS INTEGER) AS customerid,
               {DAY} AS orderdate, o_totalprice AS totalamount
        FROM orders
    """,
    "stabilize_types_wide": f"SELECT {ORDER_COLUMNS} FROM orders",
    "load_date_stamp": "SELECT c_custkey AS customerid, DATE '2025-01-01' AS date FROM customer",
    "mask_column": "SELECT c_custkey, '****' AS c_name, c_mktsegment FROM customer",
    "text_line_suffix": """
        SELECT doc_id, text || ' - Processado com sucesso!' AS value FROM documents
    """,
    "document_line_suffix": """
        SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no,
               lines[i] || ' - Processado com sucesso!' AS value
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
             unnest(range(1, len(lines) + 1)) t(i)
    """,
    "strip_tags": "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS value FROM pages",
    "bronze_orders_by_date": ONE_DAY,
    "bronze_snapshot_overwrite": CUSTOMER_SNAPSHOT,
    "bronze_append": f"{CUSTOMER_SNAPSHOT} UNION ALL {CUSTOMER_SNAPSHOT}",
    "bronze_load_orders": ONE_DAY,
    "bronze_backfill": LOADED_ORDERS,
    "empty_guard": f"""
        SELECT 'customers' AS table_name, count(*) > 0 AS written, count(*) AS rows_written
        FROM customer
        UNION ALL SELECT 'products', count(*) > 0, count(*) FROM part
        UNION ALL SELECT 'orderitems', count(*) > 0, count(*) FROM lineitem
        UNION ALL SELECT 'orders', count(*) > 0, count(*) FROM orders WHERE {DAY} = '1990-01-01'
    """,
    "audit_counts": f"""
        SELECT count(*) AS rows_read,
               count(*) FILTER (WHERE {DAY} = '1995-06-19') AS rows_kept,
               count(*) FILTER (WHERE {DAY} = '1995-06-19') AS rows_written
        FROM orders
    """,
    "silver_latest_by_key": LATEST_LINES,
    "silver_latest_one": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                           ORDER BY l_shipdate DESC NULLS LAST,
                                                    l_partkey DESC NULLS LAST,
                                                    l_quantity DESC NULLS LAST) AS r
              FROM lineitem)
        WHERE r = 1
    """,
    "silver_latest_event_by_user": """
        SELECT event_id, user_id, event_type, ts
        FROM (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST) AS r
              FROM events)
        WHERE r = 1
    """,
    "silver_full_load": LATEST_PRODUCTS,
    "silver_refresh_bucketed": LATEST_PRODUCTS,
    "gold_kpis_as_of": _report(ORDERS_AS_OF, STOCK_AFTER_DAY_2, TOP_ORDERS_AS_OF, TOP_PRODUCTS_AS_OF),
    "gold_top5_orders_as_of": TOP_ORDERS_AS_OF,
    "silver_customers_as_of": CUSTOMERS_AS_OF,
    "gold_total_orders_incremental": f"""
        SELECT count(DISTINCT o_orderkey) AS total_orders, CAST(max({MONTH}) AS DATE) AS ref_date FROM orders
    """,
    "gold_top5_products_incremental": TOP_PRODUCTS,
    "bronze_accepted": f"SELECT * FROM ({MONTHLY_ORDERS}) WHERE orderid % 7 <> 0 AND orderid % 11 <> 0",
    "bronze_rejects": f"""
        SELECT date, CAST(orderid AS VARCHAR) AS orderid, 'totalamount' AS column_name, 'n/a' AS text,
               'malformed' AS reason
        FROM ({MONTHLY_ORDERS}) WHERE orderid % 7 = 0
        UNION ALL
        SELECT date, CAST(orderid AS VARCHAR), 'customerid', customerid || repeat('0', 20), 'out of range'
        FROM ({MONTHLY_ORDERS}) WHERE orderid % 11 = 0
    """,
    "lake_read_errors": """
        SELECT CAST(DATE '2025-01-01' + CAST(c_custkey % 5 AS INTEGER) AS DATE) AS date, count(*) AS readable_rows,
               CAST(CASE WHEN c_custkey % 5 IN (1, 3) THEN 1 ELSE 0 END AS BIGINT) AS broken_files
        FROM customer GROUP BY c_custkey % 5
    """,
    "describe_columns": """
        SELECT CAST(ordinal_position AS INTEGER) AS position, column_name AS "column",
               CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
                              WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS type,
               TRUE AS nullable
        FROM (SELECT row_number() OVER () AS ordinal_position, column_name, column_type AS data_type
              FROM (DESCRIBE SELECT * FROM orders))
    """,
    "silver_stream_corrections": """
        SELECT o_orderkey AS orderid, o_custkey AS customerid,
               o_totalprice * CASE WHEN o_orderkey % 9 = 0 THEN 4 WHEN o_orderkey % 3 = 0 THEN 2
                                   WHEN o_orderkey % 2 = 0 THEN 16 ELSE 1 END AS totalamount,
               CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 9 = 0 THEN 20 WHEN o_orderkey % 3 = 0 THEN 10
                                                WHEN o_orderkey % 2 = 0 THEN 5 ELSE 0 END AS corrected_on
        FROM orders
    """,
    "bronze_orders_laid_out": HALF_YEAR_ORDERS,
    "bronze_compacted": MONTHLY_ORDERS,
    "audit_contents": f"""
        WITH months AS (
          SELECT CAST({MONTH} AS DATE) AS m FROM orders),
        ends AS (SELECT min(m) AS a, max(m) AS b FROM months),
        middle AS (
          SELECT CAST(date_trunc('month', date_trunc('month', a + CAST((b - a) // 2 AS INTEGER)) + INTERVAL 31 DAY) AS DATE) AS n
          FROM ends),
        part AS (SELECT CASE WHEN m < n THEN 0 WHEN m = n THEN 1 ELSE 2 END AS p FROM months, middle)
        SELECT count(*) AS bronze_rows, count(*) AS silver_rows, p <> 1 AS same FROM part GROUP BY p
    """,
    "history_intervals": f"""
        WITH held AS (
          SELECT customerid, lastname, date, version, version - row_number() OVER (
            PARTITION BY customerid, lastname ORDER BY version) AS run,
            lead(date) OVER (PARTITION BY customerid ORDER BY version) AS next_day
          FROM ({HISTORY_CUSTOMERS}))
        SELECT customerid, lastname, min(date) AS valid_from, max(date) AS last_seen,
               last(next_day ORDER BY date) AS valid_to, CAST(1 AS BIGINT) AS copies
        FROM held GROUP BY customerid, lastname, run
    """,
    "orders_with_customer_as_of": f"""
        SELECT orderid, customerid, day AS date, lastname
        FROM (SELECT o_orderkey AS orderid, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)
        JOIN ({HISTORY_CUSTOMERS}) ON customerid = o_custkey AND date <= day
        QUALIFY row_number() OVER (PARTITION BY orderid ORDER BY date DESC) = 1
    """,
    "silver_refresh": LATEST_PRODUCTS,
    "silver_refresh_after_gap": LATEST_PRODUCTS,
    "silver_refresh_drifted": LATEST_PRODUCTS,
    "silver_overwrite": LATEST_LINES,
    "silver_incremental_append": MONTHLY_ORDERS,
    "silver_stream_append": MONTHLY_ORDERS,
    "silver_stream_replace": MONTHLY_ORDERS,
    "silver_stream_then_batch": MONTHLY_ORDERS,
    "silver_append_mode": f"{MONTHLY_ORDERS} UNION ALL {MONTHLY_ORDERS}",
    "gold_total_orders": """
        SELECT count(DISTINCT o_orderkey) AS total_orders,
               CAST(max(o_orderdate) AS DATE) AS ref_date
        FROM orders
    """,
    "gold_total_orders_as_of": """
        SELECT count(DISTINCT o_orderkey) AS total_orders,
               CAST(max(o_orderdate) AS DATE) AS ref_date
        FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1997-07-15'
    """,
    "gold_top5_orders_value": TOP_ORDERS,
    "gold_top5_orders_of_many_customers": TOP_ORDERS,
    "gold_top5_products_sold": TOP_PRODUCTS,
    "gold_low_stock_products": LOW_STOCK.format(stock="p_size"),
    "gold_kpi_roundtrip": TOP_PRODUCTS,
    "kpi_missing_default": _report("0", "p_size"),
    "report_headline": f"SELECT {COUNT_ORDERS} AS total_orders",
    "report_orders_table": TOP_ORDERS,
    "report_products_series": TOP_PRODUCTS,
    "report_stock_series": LOW_STOCK.format(stock="p_size"),
    "kpi_report": _report(COUNT_ORDERS, "p_size"),
    "medallion_end_to_end": _report(COUNT_ORDERS, STOCK_AFTER_DAY_2),
}
