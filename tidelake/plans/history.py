"""Bronze snapshots to histories, which know the table as of any day.

A history is kept as one folder of the rows still valid and one folder for each load
of rows that ended in it; a load writes the open rows again and adds what it ended.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake import folders
from tidelake.operators.guards import Audit, counted, require_contract
from tidelake.operators.history import TO, as_of, extended, history_schema, intervals
from tidelake.plans.gold import loaded_by
from tidelake.sinks.lake import new_version, publish
from tidelake.sources.lake import bronze_days, current_version, snapshot_scan, stored_scan, table_paths
from tidelake.specs import TableSpec

OPEN = "open"


def _read(spark: SparkSession, spec: TableSpec, paths: list[str]) -> DataFrame:
    schema = history_schema(spec.schema)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _write(rows: DataFrame, spec: TableSpec, path: str, days: Mapping[str, str], kept: Mapping[str, str]) -> Audit:
    """The rows split by whether they are still valid, in one pass; ``kept`` are folders of rows that ended before."""
    spark, folder = rows.sparkSession, new_version()
    rows, observation = counted(rows.withColumn("ended", F.col(TO).isNotNull()))
    rows.write.option("partitionOverwriteMode", "static").mode("overwrite").partitionBy("ended").parquet(f"{path}/{folder}")
    parts, there = dict(kept), folders.names(spark, f"{path}/{folder}")
    for name, part in ((OPEN, "ended=false"), (max(days), "ended=true")):
        if part in there:
            parts[name] = f"{folder}/{part}"
    publish(spark, path, parts, days)
    return Audit(spec.name, path, observation.get["rows"])


def refresh(spark: SparkSession, spec: TableSpec, bronze_root: str, history_root: str) -> Audit:
    """Bring a table's history up to date with its bronze snapshots.

    Days that follow those it was made from are added one by one.  If a day within was
    added, written again or taken away, the history is made anew from all of bronze.
    """
    source, path = f"{bronze_root}/{spec.name}", f"{history_root}/{spec.name}"
    days, current = bronze_days(spark, spec, source), current_version(spark, path)
    known = current.days if current else {}
    changed = sorted(d for d in {*days, *known} if days.get(d) != known.get(d))
    if not changed:
        return Audit(spec.name, path, 0)
    if current is None or changed[0] <= max(known, default=""):
        rows = require_contract(stored_scan(spark, spec, source, days), spec)
        return _write(intervals(rows, spec.key, [date.fromisoformat(d) for d in sorted(days)]), spec, path, days, {})
    written = 0
    for day in changed:
        current = current_version(spark, path)
        open_rows = _read(spark, spec, [f"{path}/{current.parts[OPEN]}"] if OPEN in current.parts else [])
        before = date.fromisoformat(max(current.days)) if current.days else None
        snapshot = require_contract(stored_scan(spark, spec, source, [day]), spec)
        rows = extended(open_rows, snapshot, spec.key, date.fromisoformat(day), before)
        kept = {name: folder for name, folder in current.parts.items() if name != OPEN}
        written += _write(rows, spec, path, current.days | {day: days[day]}, kept).rows_written
    return Audit(spec.name, path, written)


def history_scan(spark: SparkSession, spec: TableSpec, history_root: str) -> DataFrame:
    return _read(spark, spec, table_paths(spark, f"{history_root}/{spec.name}"))


def table_as_of(spark: SparkSession, spec: TableSpec, history_root: str, day: date) -> DataFrame:
    """A snapshot table as a full load of the days up to ``day`` would have it."""
    current = current_version(spark, f"{history_root}/{spec.name}")
    if current is None:
        raise FileNotFoundError(f"no history of {spec.name} in {history_root}")
    days = [date.fromisoformat(d) for d in current.days]
    return as_of(history_scan(spark, spec, history_root), day, days).select(*spec.lake_schema.fieldNames())


def tables_as_of(
    spark: SparkSession, specs: Mapping[str, TableSpec], silver_root: str, history_root: str, day: date
) -> dict[str, DataFrame]:
    """All tables as they were on ``day``: snapshot tables from their history, others by their load date."""
    return {
        name: loaded_by(snapshot_scan(spark, spec, f"{silver_root}/{name}"), day)
        if spec.incremental
        else table_as_of(spark, spec, history_root, day)
        for name, spec in specs.items()
    }
