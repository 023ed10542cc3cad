"""Bronze to silver: latest row per key, or the run date's rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidelake.operators.guards import Audit, require_contract
from tidelake.operators.latest import latest_by_key, update_by_key
from tidelake.plans.audit import record
from tidelake.sinks.lake import Layout, bucket_of, replace_buckets, replace_table, write_days
from tidelake.sources.lake import bronze_days, current_version, snapshot_scan, stored_scan
from tidelake.specs import LOAD_DATE, TableSpec


def _latest(rows: DataFrame, spec: TableSpec, ties: str) -> DataFrame:
    return latest_by_key(require_contract(rows, spec), spec.key, LOAD_DATE, ties)


def full_load(
    spark: SparkSession,
    spec: TableSpec,
    bronze_root: str,
    silver_root: str,
    ties: str = "all",
    upto: date | None = None,
    buckets: int | None = None,
) -> Audit:
    """Recompute a table from its snapshots, all or those up to a day, and replace it.

    A row gone from the source stays, with its last known values.  Nothing in
    bronze leaves silver as it is, or empty if it was never written.  With
    ``buckets`` the table is kept in so many buckets of its key (0: in one folder);
    without, as it was.
    """
    source, path = f"{bronze_root}/{spec.name}", f"{silver_root}/{spec.name}"
    days = bronze_days(spark, spec, source)
    if upto is not None:
        days = {d: stamp for d, stamp in days.items() if d <= upto.isoformat()}
    rows = stored_scan(spark, spec, source, days)
    latest = _latest(rows, spec, ties)
    current = current_version(spark, path)
    if not days and current is not None:
        return Audit(spec.name, path, 0)
    if buckets is None:
        buckets = current.buckets if current else 0
    if buckets:
        return replace_buckets(latest, spec.name, path, spec.key, buckets, days)
    return replace_table(latest, spec.name, path, days)


def refresh(
    spark: SparkSession,
    spec: TableSpec,
    bronze_root: str,
    silver_root: str,
    run_date: date,
    ties: str = "all",
    buckets: int | None = None,
) -> Audit:
    """``full_load`` up to the run date that reads silver plus the snapshots not in it yet.

    Silver knows the bronze days it was made from, and the print of each.  Days
    that follow them all are merged, however many they are.  If there is no silver
    yet, or a day within was added, written again or taken away, the full load runs,
    up to the run date or the newest day that silver has.

    A table in buckets is read and written only in the buckets that the new
    snapshots' keys are in; the new version keeps the other buckets' folders.
    """
    source, path = f"{bronze_root}/{spec.name}", f"{silver_root}/{spec.name}"
    current = current_version(spark, path)
    if current is None:
        return full_load(spark, spec, bronze_root, silver_root, ties, run_date, buckets)
    days = bronze_days(spark, spec, source)
    newest = max(current.days, default="")
    upto = max(run_date.isoformat(), newest)
    changed = [d for d in {*days, *current.days} if d <= upto and days.get(d) != current.days.get(d)]
    if any(d <= newest for d in changed) or buckets not in (None, current.buckets):
        return full_load(spark, spec, bronze_root, silver_root, ties, date.fromisoformat(upto), buckets)
    if not changed:
        return Audit(spec.name, path, 0)
    merged_days = current.days | {d: days[d] for d in changed}
    newer = _latest(stored_scan(spark, spec, source, changed), spec, ties)
    if not current.buckets:
        merged = update_by_key(snapshot_scan(spark, spec, path), newer, spec.key, LOAD_DATE, ties)
        return replace_table(merged, spec.name, path, merged_days)
    # At most one row for each bucket.
    keys = stored_scan(spark, spec, source, changed).select(bucket_of(spec.key, current.buckets).alias("bucket"))
    touched = {str(row["bucket"]) for row in keys.distinct().collect()}
    held = [f"{path}/{folder}" for part, folder in current.parts.items() if part in touched]
    old = spark.read.schema(spec.lake_schema).parquet(*held) if held else spark.createDataFrame([], spec.lake_schema)
    merged = update_by_key(old, newer, spec.key, LOAD_DATE, ties)
    kept = {part: folder for part, folder in current.parts.items() if part not in touched}
    return replace_buckets(merged, spec.name, path, spec.key, current.buckets, merged_days, kept)


def merge_versions(rows: DataFrame, spec: TableSpec, version: str, silver_root: str, buckets: int) -> Audit:
    """Merge rows into a table in buckets that keeps one row per key, that of the newest ``version``.

    ``version`` is a column of the table.  Only buckets that the rows' keys are in are
    read and written.  The order in which rows come, and repeats, make no difference.
    """
    spark, path = rows.sparkSession, f"{silver_root}/{spec.name}"
    current = current_version(spark, path)
    if current is not None and current.buckets != buckets:
        raise ValueError(f"{path} is in {current.buckets} buckets, not {buckets}")
    parts = current.parts if current else {}
    # At most one row for each bucket.
    touched = {str(r["bucket"]) for r in rows.select(bucket_of(spec.key, buckets).alias("bucket")).distinct().collect()}
    if not touched:
        return Audit(spec.name, path, 0)
    both = rows.select(*spec.columns)
    held = [f"{path}/{folder}" for part, folder in parts.items() if part in touched]
    if held:
        both = both.unionByName(spark.read.schema(spec.schema).parquet(*held))
    kept = {part: folder for part, folder in parts.items() if part not in touched}
    return replace_buckets(latest_by_key(both, spec.key, version, ties="one"), spec.name, path, spec.key, buckets, kept=kept)


def incremental(
    spark: SparkSession,
    spec: TableSpec,
    bronze_root: str,
    silver_root: str,
    run_date: date,
    last: date | None = None,
    mode: str = "overwrite",
    audits_root: str | None = None,
    layout: Layout | None = None,
) -> Audit:
    """Move a run date's rows, or those of ``run_date..last``, to silver.

    With ``audits_root`` the load is recorded there, with a print of its rows to
    compare with the bronze load of the same days.
    """
    source = f"{bronze_root}/{spec.name}"
    upto = last or run_date
    days = [d for d in bronze_days(spark, spec, source) if run_date.isoformat() <= d <= upto.isoformat()]
    audit = write_days(
        require_contract(stored_scan(spark, spec, source, days), spec),
        spec.name,
        f"{silver_root}/{spec.name}",
        mode,
        days="whole" if last is None else "many",
        layout=layout,
        fingerprint=audits_root is not None,
    )
    if audits_root is not None:
        record(spark, audits_root, "silver", audit, run_date, upto)
    return audit
