"""Source to bronze: select, filter to the run date, cast, stamp, write."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake import folders
from tidelake.operators.guards import Audit, counted
from tidelake.operators.rejects import ERROR, ERRORS, accepted, rejected, with_errors
from tidelake.operators.rows import (
    on_run_date,
    on_run_dates,
    select_columns,
    stabilize_types,
    stamp_load_date,
)
from tidelake.plans.audit import record
from tidelake.sinks.lake import Layout, write_days
from tidelake.specs import LOAD_DATE, TableSpec


def transform(
    source: DataFrame, spec: TableSpec, run_date: date, lenient: bool = False
) -> DataFrame:
    """The rows one run loads.

    The day filter comes before the casts, on the untouched source column, so
    the source itself can apply it.
    """
    rows = select_columns(source, spec)
    if spec.incremental:
        rows = on_run_date(rows, spec, run_date)
    return stamp_load_date(stabilize_types(rows, spec, lenient), run_date)


def _load_accepted(rows: DataFrame, spec: TableSpec, bronze_root: str, rejects_root: str, days: str) -> Audit:
    """Load the rows whose values can be cast, and keep the others apart with the reasons.

    Rejected rows are counted in the pass that writes the accepted ones.  Only if there
    are any, the source is read once more for them; if it has more than before, it
    changed meanwhile, which raises.
    """
    checked, counts = counted(with_errors(rows, spec), rejected=F.size(ERRORS) > 0)
    audit = write_days(stabilize_types(accepted(checked), spec), spec.name, f"{bronze_root}/{spec.name}", days=days)
    if not (seen := counts.get["rejected"]):
        return audit
    apart = rejected(with_errors(rows, spec), LOAD_DATE)
    found = write_days(apart, spec.name, f"{rejects_root}/{spec.name}", days="many").rows_written
    if found > seen:
        raise RuntimeError(f"{spec.name}: {found} malformed rows after {seen}; the source changed")
    return replace(audit, rows_rejected=found)


def _forget_rejects(spark: SparkSession, spec: TableSpec, rejects_root: str, first: date, last: date) -> None:
    path = f"{rejects_root}/{spec.name}"
    for name in folders.names(spark, path):
        if f"{LOAD_DATE}={first}" <= name <= f"{LOAD_DATE}={last}":
            folders.remove(spark, f"{path}/{name}")


def rejects_scan(spark: SparkSession, spec: TableSpec, rejects_root: str) -> DataFrame:
    """The rejected rows of a table: errors, row (JSON), date."""
    schema = f"{ERRORS} {ERROR}, row string, {LOAD_DATE} date"
    path = f"{rejects_root}/{spec.name}"
    there = any(n.startswith(f"{LOAD_DATE}=") for n in folders.names(spark, path))
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def load(
    source: DataFrame,
    spec: TableSpec,
    bronze_root: str,
    run_date: date,
    mode: str = "overwrite",
    lenient: bool = False,
    rejects_root: str | None = None,
    audits_root: str | None = None,
    layout: Layout | None = None,
) -> Audit:
    """Load one table for one run date into ``<table>/date=<run date>``.

    A malformed value raises, or is NULL with ``lenient``; with ``rejects_root`` its row
    goes to ``<rejects_root>/<table>/date=<run date>`` instead, with column, text and reason.
    """
    if rejects_root is not None:
        rows = select_columns(source, spec)
        rows = on_run_date(rows, spec, run_date) if spec.incremental else rows
        _forget_rejects(source.sparkSession, spec, rejects_root, run_date, run_date)
        days = "sparse" if spec.incremental else "whole"
        return _load_accepted(stamp_load_date(rows, run_date), spec, bronze_root, rejects_root, days)
    rows = transform(source, spec, run_date, lenient)
    days = "sparse" if spec.incremental else "whole"
    return _written(rows, spec, bronze_root, mode, days, layout, audits_root, run_date, run_date)


def _written(
    rows: DataFrame,
    spec: TableSpec,
    bronze_root: str,
    mode: str,
    days: str,
    layout: Layout | None,
    audits_root: str | None,
    first: date,
    last: date,
) -> Audit:
    path = f"{bronze_root}/{spec.name}"
    audit = write_days(rows, spec.name, path, mode, days, layout, fingerprint=audits_root is not None)
    if audits_root is not None:
        record(rows.sparkSession, audits_root, "bronze", audit, first, last)
    return audit


def backfill(
    source: DataFrame,
    spec: TableSpec,
    bronze_root: str,
    first: date,
    last: date,
    lenient: bool = False,
    rejects_root: str | None = None,
    audits_root: str | None = None,
    layout: Layout | None = None,
) -> Audit:
    """Load an incremental table for every day of ``first..last`` in one job.

    With ``audits_root`` the load is recorded there with a print of its rows.
    """
    if not spec.incremental:
        raise ValueError(f"{spec.name} has no day column; load a snapshot instead")
    rows = on_run_dates(select_columns(source, spec), spec, first, last)
    if rejects_root is not None:
        _forget_rejects(source.sparkSession, spec, rejects_root, first, last)
        return _load_accepted(rows, spec, bronze_root, rejects_root, "many")
    rows = stabilize_types(rows, spec, lenient)
    return _written(rows, spec, bronze_root, "overwrite", "many", layout, audits_root, first, last)
