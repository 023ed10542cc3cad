"""SQLite files as a Spark data source, for sessions without the JDBC jar.

Read options: ``path`` (one database file, or a folder of them with the same
table), ``table`` or ``query``, and for a single file ``partitionColumn`` and
``numPartitions`` to read key ranges in parallel.  Write option: ``path``, a
folder that receives one database file per task, and ``table``.

The path must be one that every executor can open as a file.
"""

from __future__ import annotations

import os
import sqlite3
import sys
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import closing
from dataclasses import dataclass
from urllib.parse import quote, urlparse

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from tidelake.sources.jdbc import relation

FORMAT = "sqlite"
BATCH_ROWS = 10_000
SHARD_SUFFIX = ".db"
PENDING_SUFFIX = ".pending"

COMPARISONS = {
    EqualTo: "=",
    GreaterThan: ">",
    GreaterThanOrEqual: ">=",
    LessThan: "<",
    LessThanOrEqual: "<=",
}
PARSERS = {
    T.StringType: str,
    T.IntegerType: int,
    T.LongType: int,
    T.DoubleType: float,
}


def local_path(path: str) -> str:
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"SQLite needs a file path, not {path!r}")
    return url.path


def connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)


@dataclass
class Scan(InputPartition):
    """One task: a database file and the condition that selects its rows."""

    file: str
    condition: str = ""
    arguments: tuple = ()


def superset_condition(filter: Filter, types: dict[str, T.DataType]) -> tuple[str, tuple] | None:
    """A condition no stricter than the filter, or None.

    SQLite compares values of different storage classes its own way, so a value
    stored in another class than the column's type always passes; Spark applies
    every filter again to the parsed values.
    """
    if not isinstance(filter, (*COMPARISONS, In)) or len(filter.attribute) != 1:
        return None
    name = filter.attribute[0]
    if isinstance(types.get(name), T.StringType):
        classes, collation = "('text', 'null')", " COLLATE BINARY"
    elif isinstance(types.get(name), (T.IntegerType, T.LongType, T.DoubleType)):
        classes, collation = "('integer', 'real', 'null')", ""
    else:
        return None
    if isinstance(filter, In):
        arguments = tuple(filter.value)
        test = f"[{name}]{collation} IN ({', '.join('?' * len(arguments))})"
    else:
        arguments = (filter.value,)
        test = f"[{name}]{collation} {COMPARISONS[type(filter)]} ?"
    if not all(isinstance(a, (str, int, float)) for a in arguments):
        return None
    return f"(typeof([{name}]) NOT IN {classes} OR {test})", arguments


def key_ranges(column: str, low, high, count: int) -> list[tuple[str, tuple]]:
    """``count`` adjacent ranges; the outer ones are open and take the NULLs."""
    cuts = sorted({low + (high - low) * i // count for i in range(1, count)})
    if not cuts:
        return [("", ())]
    ranges = [(f"([{column}] < ? OR [{column}] IS NULL)", (cuts[0],))]
    ranges += [
        (f"([{column}] >= ? AND [{column}] < ?)", pair) for pair in zip(cuts, cuts[1:])
    ]
    return [*ranges, (f"[{column}] >= ?", (cuts[-1],))]


class SQLiteReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema = schema
        self.path = local_path(options["path"])
        self.relation = relation(options.get("table", ""), options.get("query"))
        self.partition_column = options.get("partitionColumn")
        self.num_partitions = int(options.get("numPartitions", 1))
        self.filters: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        types = {field.name: field.dataType for field in self.schema.fields}
        for filter in filters:
            condition = superset_condition(filter, types)
            if condition is not None:
                self.filters.append(condition)
            yield filter

    def partitions(self) -> Sequence[InputPartition]:
        if os.path.isdir(self.path):
            return [
                Scan(os.path.join(self.path, name))
                for name in sorted(os.listdir(self.path))
                if name.endswith(SHARD_SUFFIX)
            ]
        if not self.partition_column or self.num_partitions <= 1:
            return [Scan(self.path)]
        column = self.partition_column
        with closing(connect(self.path)) as database:
            low, high = database.execute(
                f"SELECT MIN([{column}]), MAX([{column}]) FROM {self.relation}"
            ).fetchone()
        if low is None:
            return [Scan(self.path)]
        return [
            Scan(self.path, condition, arguments)
            for condition, arguments in key_ranges(
                column, int(low), int(high), self.num_partitions
            )
        ]

    def read(self, partition: Scan) -> Iterator[pa.RecordBatch]:
        names = ", ".join(f"[{name}]" for name in self.schema.fieldNames())
        conditions = [*self.filters]
        if partition.condition:
            conditions.append((partition.condition, partition.arguments))
        where = " AND ".join(condition for condition, _ in conditions) or "1"
        arguments = [a for _, some in conditions for a in some]
        arrow = to_arrow_schema(self.schema)
        parsers = [PARSERS[type(field.dataType)] for field in self.schema.fields]
        with closing(connect(partition.file)) as database:
            cursor = database.execute(
                f"SELECT {names} FROM {self.relation} WHERE {where}", arguments
            )
            while rows := cursor.fetchmany(BATCH_ROWS):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(
                            [None if value is None else parse(value) for value in values],
                            type=field.type,
                        )
                        for values, parse, field in zip(zip(*rows), parsers, arrow)
                    ],
                    schema=arrow,
                )


@dataclass
class Shard(WriterCommitMessage):
    pending: str


class SQLiteShardWriter(DataSourceArrowWriter):
    """Each task writes its own file; the commit makes those of the successful tasks visible."""

    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.columns = schema.fieldNames()
        self.folder = local_path(options["path"])
        self.table = options["table"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        os.makedirs(self.folder, exist_ok=True)
        pending = os.path.join(self.folder, f"part-{uuid.uuid4().hex}{PENDING_SUFFIX}")
        names = ", ".join(f"[{name}]" for name in self.columns)
        marks = ", ".join("?" * len(self.columns))
        with closing(sqlite3.connect(pending)) as database, database:
            database.execute(f"CREATE TABLE [{self.table}] ({names})")
            for batch in iterator:
                columns = [column.to_pylist() for column in batch.columns]
                database.executemany(
                    f"INSERT INTO [{self.table}] VALUES ({marks})", zip(*columns)
                )
        return Shard(pending)

    def commit(self, messages: list[Shard | None]) -> None:
        for message in messages:
            if message is not None:
                os.rename(
                    message.pending, message.pending.removesuffix(PENDING_SUFFIX) + SHARD_SUFFIX
                )

    def abort(self, messages: list[Shard | None]) -> None:
        for message in messages:
            if message is not None and os.path.exists(message.pending):
                os.remove(message.pending)


class SQLiteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        """Without a given schema every column is text, to be cast afterwards."""
        path = local_path(self.options["path"])
        if os.path.isdir(path):
            raise ValueError("give a schema to read a folder of databases")
        source = relation(self.options.get("table", ""), self.options.get("query"))
        with closing(connect(path)) as database:
            cursor = database.execute(f"SELECT * FROM {source} LIMIT 0")
            return T.StructType([T.StructField(c[0], T.StringType()) for c in cursor.description])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return SQLiteReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("SQLite shards are written with mode 'append'")
        return SQLiteShardWriter(schema, self.options)


def register(spark: SparkSession) -> None:
    """Make ``format("sqlite")`` known; executors get this module's code by value."""
    for module in (__name__, relation.__module__):
        cloudpickle.register_pickle_by_value(sys.modules[module])
    spark.dataSource.register(SQLiteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def sqlite_scan(
    spark: SparkSession,
    path: str,
    table: str,
    query: str | None = None,
    schema: T.StructType | None = None,
    partition_column: str | None = None,
    num_partitions: int = 1,
) -> DataFrame:
    """Lazy scan of a table or query in SQLite; filters are pushed to it.

    ``rowid`` is a good ``partition_column`` for a bare table.
    """
    register(spark)
    options = {"path": path, "table": table, "numPartitions": str(num_partitions)}
    if query:
        options["query"] = query
    if partition_column:
        options["partitionColumn"] = partition_column
    reader = spark.read.format(FORMAT).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def write_sqlite_shards(df: DataFrame, path: str, table: str) -> None:
    register(df.sparkSession)
    df.write.format(FORMAT).mode("append").options(path=path, table=table).save()
