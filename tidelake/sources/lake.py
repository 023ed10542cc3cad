"""Parquet scans of lake folders laid out as ``<table>/date=<day>/``."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from datetime import date
from functools import reduce
from hashlib import md5
from multiprocessing.pool import ThreadPool
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake import folders
from tidelake.operators.rows import stabilize_types
from tidelake.specs import KPIS, LOAD_DATE, KpiSpec, TableSpec

PREVIEW_ROWS = 5
POINTER = "_current-"
#: Spark's readers pass over a folder of such a name.
COMPACTED = "_compacted"
VERSION = "v-"
FOOTER_READERS = 16


class Version(NamedTuple):
    """A table's current version: its pointer's number, its folders by part, and the bronze days in it.

    A table replaced as a whole has one part, "".  A table in ``buckets`` has a part
    for each bucket that holds rows.
    """

    number: int
    parts: dict[str, str]
    days: dict[str, str]
    buckets: int = 0
    #: Of compacted days: which part holds a day's rows.
    place: dict[str, str] = {}  # noqa: RUF012


def current_version(spark: SparkSession, path: str) -> Version | None:
    """What the newest pointer of a replaced table names; None for other folders."""
    pointers = [n for n in folders.names(spark, path) if n.startswith(POINTER)]
    if not pointers:
        return None
    told = json.loads(folders.read_text(spark, f"{path}/{pointers[-1]}"))
    parts = told["parts"] if "parts" in told else {"": told["folder"]}
    return Version(int(pointers[-1].removeprefix(POINTER)), parts, told["days"], told.get("buckets", 0), told.get("place", {}))


def table_paths(spark: SparkSession, path: str) -> list[str]:
    """Where a table's files are: the current version's folders, or the folder itself."""
    version = current_version(spark, path)
    return [f"{path}/{folder}" for folder in version.parts.values()] if version else [path]


def table_path(spark: SparkSession, path: str) -> str:
    """The one folder of a table that is not in buckets."""
    paths = table_paths(spark, path)
    if len(paths) != 1:
        raise ValueError(f"{path} is in {len(paths)} folders; see table_paths")
    return paths[0]


def snapshot_scan(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """All days of a table, or the current version of a replaced one.

    The folder supplies ``date`` where there are days.  The declared schema is
    applied on read, so a table without any day yet does not break the scan;
    ``stored_scan`` is for days of other stored types.
    """
    compacted = compacted_rows(spark, spec, root)
    if compacted is not None:
        if not folder_days(spark, root):
            return compacted
        return spark.read.schema(spec.lake_schema).parquet(root).unionByName(compacted)
    paths = table_paths(spark, root)
    if not paths:
        return spark.createDataFrame([], spec.lake_schema)
    return spark.read.schema(spec.lake_schema).parquet(*paths)


def folder_days(spark: SparkSession, root: str) -> set[str]:
    """The days that have a folder."""
    prefix = f"{LOAD_DATE}="
    return {n.removeprefix(prefix) for n in folders.names(spark, root) if n.startswith(prefix)}


def compacted_version(spark: SparkSession, root: str) -> Version | None:
    """What the compacted days of a table lie in, if it has any."""
    return current_version(spark, f"{root}/{COMPACTED}")


def compacted_rows(
    spark: SparkSession, spec: TableSpec, root: str, days: Iterable[str] | None = None
) -> DataFrame | None:
    """Rows of compacted days, all or some; days that have a folder, which counts first, are left out."""
    version = compacted_version(spark, root)
    if version is None:
        return None
    wanted = set(version.place) - folder_days(spark, root)
    wanted = wanted if days is None else wanted & set(days)
    whole, cut = [], []
    for part in sorted({version.place[d] for d in wanted}):
        here = {d for d, p in version.place.items() if p == part}
        (whole if here <= wanted else cut).append((part, sorted(here & wanted)))
    rows = spark.createDataFrame([], spec.lake_schema)
    reader = spark.read.schema(spec.lake_schema)
    # A part may also hold days that were compacted anew into another.
    for part, some in cut + whole:
        one = reader.parquet(f"{root}/{COMPACTED}/{part}")
        stored = F.col(LOAD_DATE)
        rows = rows.unionByName(one.where(stored.between(F.lit(some[0]).cast("date"), F.lit(some[-1]).cast("date")) & stored.isin([date.fromisoformat(d) for d in some])))
    return rows


def bronze_days(spark: SparkSession, spec: TableSpec, root: str) -> dict[str, str]:
    """Each day of a table with a print of its files' names: a day written again has another."""
    compacted = compacted_version(spark, root)
    before = compacted.days if compacted else {}
    try:
        files = spark.read.schema(spec.lake_schema).parquet(root).inputFiles()
    except AnalysisException as error:
        if _is_missing(error):
            return dict(before)
        raise
    by_day: dict[str, list[str]] = {}
    for file in files:
        found = re.search(rf"/{LOAD_DATE}=([^/]+)/(.+)$", file)
        if found:
            by_day.setdefault(found[1], []).append(found[2])
    return before | {day: md5("\n".join(sorted(own)).encode()).hexdigest() for day, own in by_day.items()}


def stored_scan(
    spark: SparkSession, spec: TableSpec, root: str, days: Iterable[str] | None = None
) -> DataFrame:
    """Days of a table by their stored types, cast to the declared ones.

    Spark merges the files' schemas in one job.  Only if they disagree are the day
    folders grouped by the schema that each has, and each group is cast by itself.
    A malformed value raises.
    """
    there = [n for n in folders.names(spark, root) if n.startswith(f"{LOAD_DATE}=")]
    wanted = None if days is None else {f"{LOAD_DATE}={day}" for day in days}
    paths = [f"{root}/{n}" for n in there if wanted is None or n in wanted]
    compacted = compacted_rows(spark, spec, root, days)
    if compacted is not None:
        rest = _stored_folders(spark, spec, root, paths) if paths else spark.createDataFrame([], spec.lake_schema)
        return rest.unionByName(compacted)
    if not paths:
        return spark.createDataFrame([], spec.lake_schema)
    return _stored_folders(spark, spec, root, paths)


def _stored_folders(spark: SparkSession, spec: TableSpec, root: str, paths: list[str]) -> DataFrame:
    """Day folders, each by the types it is stored in."""

    def read(some: list[str], schema: T.StructType | None = None) -> DataFrame:
        reader = spark.read.option("basePath", root)
        reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
        rows = reader.parquet(*some)
        rows = rows.withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in spec.schema.fields if f.name not in rows.columns}
        )
        return stabilize_types(rows, spec).select(*spec.columns, F.col(LOAD_DATE).cast("date"))

    def stored(path: str) -> tuple[str, T.StructType]:
        return path, spark.read.option("basePath", root).option("mergeSchema", "true").parquet(path).schema

    try:
        return read(paths)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    with ThreadPool(FOOTER_READERS) as pool:
        for path, schema in pool.map(stored, paths):
            groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return reduce(DataFrame.unionByName, [read(some, schema) for schema, some in groups.values()])


def partition_scan(
    spark: SparkSession, spec: TableSpec, root: str, first: date, last: date | None = None
) -> DataFrame:
    """One day, or the days ``first..last``; other folders are pruned, not read."""
    return snapshot_scan(spark, spec, root).where(
        F.col(LOAD_DATE).between(F.lit(first), F.lit(last or first))
    )


def silver_tables(
    spark: SparkSession, root: str, specs: dict[str, TableSpec]
) -> dict[str, DataFrame]:
    """All silver tables; one that was never written to its end is an error.

    A table that is loaded by day has the days it has, or none yet.
    """
    for name, spec in specs.items():
        if not spec.incremental and current_version(spark, f"{root}/{name}") is None:
            raise FileNotFoundError(f"silver has no complete table {name} in {root}")
    return {name: snapshot_scan(spark, spec, f"{root}/{name}") for name, spec in specs.items()}


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def kpi_scan(spark: SparkSession, gold_root: str, run_date: date, name: str) -> DataFrame:
    """One KPI of a run date; its default rows if no Parquet file is there.

    Columns keep their stored types where the KPI was written.  An unknown KPI
    that was never written is an empty frame without columns.
    """
    spec = KPIS.get(name, KpiSpec(name, T.StructType()))
    try:
        return spark.read.parquet(f"{gold_root}/{LOAD_DATE}={run_date}/{name}/*.parquet")
    except AnalysisException as error:
        if not _is_missing(error):
            raise
    return spark.createDataFrame(list(spec.default_rows), spec.schema)


def preview(
    spark: SparkSession,
    spec: TableSpec,
    root: str,
    run_date: date,
    n: int = PREVIEW_ROWS,
    ordered: bool = True,
) -> DataFrame:
    """``n`` rows of one day: the first in column order, or any, which reads less."""
    day = partition_scan(spark, spec, root, run_date)
    if ordered:
        day = day.orderBy(*[F.col(c).asc_nulls_first() for c in day.columns])
    return day.limit(n)


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """(path, error) of each Parquet file below ``path`` that can't be read to its end.

    The files are spread over the cluster, one at a time in a task: Spark reads a file's
    bytes, whatever store it lies in, and every row group of them is decoded.  A file
    that can't be opened at all, or has over two gigabytes, raises.
    """
    # A session of its own, so that a batch holds one file.
    session = spark.newSession()
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    session.conf.set("spark.sql.files.openCostInBytes", session.conf.get("spark.sql.files.maxPartitionBytes"))
    files = (
        session.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "content")
    )
    return files.mapInArrow(_unreadable, "path string, error string")


def _unreadable(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        for place, content in zip(batch.column("path"), batch.column("content"), strict=True):
            try:
                file = pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                for group in range(file.num_row_groups):
                    file.read_row_group(group, use_threads=False)
            except (OSError, pa.ArrowException) as error:
                yield pa.RecordBatch.from_pydict({"path": [place.as_py()], "error": [str(error)]})


def readable_days(spark: SparkSession, spec: TableSpec, root: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the files that can be read, errors of the others) of a table kept by day."""
    errors = read_errors(spark, root)
    bad = {row["path"] for row in errors.select("path").collect()}
    files = spark.read.schema(spec.lake_schema).parquet(root).inputFiles()
    fine = [f for f in files if _plain_path(f) not in {_plain_path(b) for b in bad}]
    if not fine:
        return spark.createDataFrame([], spec.lake_schema), errors
    return spark.read.schema(spec.lake_schema).option("basePath", root).parquet(*fine), errors


def _plain_path(path: str) -> str:
    """A path without the differences between the ways Spark writes it."""
    return unquote(re.sub(r"^file:/+", "/", path))


def describe_columns(df: DataFrame) -> DataFrame:
    """The schema of a frame as rows ``position, column, type, nullable``."""
    return df.sparkSession.createDataFrame(
        [
            (position, field.name, field.dataType.simpleString(), field.nullable)
            for position, field in enumerate(df.schema.fields, start=1)
        ],
        "position INT, column STRING, type STRING, nullable BOOLEAN",
    )
