"""Parquet writers.  Each returns what it wrote, counted in the writing pass."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake import folders
from tidelake.operators.guards import Audit, counted, fingerprinted
from tidelake.sources.lake import POINTER, VERSION, compacted_version, current_version
from tidelake.specs import LOAD_DATE

MODES = ("overwrite", "append")
BUCKET = "bucket"


@dataclass(frozen=True)
class Layout:
    """How rows lie in files, for lookups that skip data.

    Files and row groups are ranges of ``sort``; equal keys, however many, spread over
    tasks by a hash of the row.  Columns in ``bloom`` have a Bloom filter in each row
    group, for lookups by values that are not sorted.
    """

    sort: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()
    row_group_bytes: int | None = None

    def applied(self, df: DataFrame, *before: str) -> DataFrame:
        if not self.sort:
            return df
        spread = F.xxhash64(*[F.col(c) for c in df.columns])
        return df.repartitionByRange(*before, *self.sort, spread).sortWithinPartitions(*before, *self.sort)

    @property
    def options(self) -> dict[str, str]:
        chosen = {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.bloom}
        if self.bloom:
            chosen["parquet.bloom.filter.adaptive.enabled"] = "true"
        if self.row_group_bytes:
            chosen["parquet.block.size"] = str(self.row_group_bytes)
        return chosen


def write_days(
    df: DataFrame,
    table: str,
    path: str,
    mode: str = "overwrite",
    days: str = "whole",
    layout: Layout | None = None,
    fingerprint: bool = False,
) -> Audit:
    """Write into ``<path>/date=<day>/`` folders.

    ``overwrite`` replaces only the days present in ``df``, so running a day
    again gives the same table.  ``append`` adds to them, and running a day
    again adds its rows again.  No rows, no day folder.

    ``days`` says how the rows lie in the input partitions.  ``whole``: every
    partition is a good output file as it is.  ``sparse``: one day picked from a
    large input, so rows are gathered from partitions that have few.  ``many``:
    rows are gathered by day, else every task would write a file for every day.
    Adaptive execution sizes gathered partitions, and splits a day that holds
    far more rows than the others.  With a ``layout`` the rows are dealt by it instead.

    With ``fingerprint`` the audit has an order-free print of the rows, taken in the
    writing pass.  Compacted days can be replaced, but not appended to.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "append" and compacted_version(df.sparkSession, path) is not None:
        raise ValueError(f"{path} has compacted days; replace a day instead")
    if layout is not None:
        df = layout.applied(df, LOAD_DATE)
    elif days == "sparse":
        df = df.hint("rebalance")
    elif days == "many":
        df = df.hint("rebalance", LOAD_DATE)
    elif days != "whole":
        raise ValueError(f"days must be 'whole', 'sparse' or 'many', not {days!r}")
    df, observation = fingerprinted(df) if fingerprint else counted(df)
    (
        df.write.mode(mode)
        .options(**(layout.options if layout else {}))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_DATE)
        .parquet(path)
    )
    seen = observation.get
    return Audit(table, path, seen["rows"], fingerprint=seen.get("fingerprint"))


def overwrite_table(df: DataFrame, table: str, path: str) -> Audit:
    """Replace a whole unpartitioned table in place; ``date`` stays a data column."""
    df, observation = counted(df)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return Audit(table, path, observation.get["rows"])


def publish(
    spark: SparkSession,
    path: str,
    parts: Mapping[str, str],
    days: Mapping[str, str] | None = None,
    buckets: int = 0,
    place: Mapping[str, str] | None = None,
) -> None:
    """Make ``parts`` (folders under ``path`` by name) the table.

    A small numbered pointer, written last, does it.  Until then, and if the run
    dies, readers see the old version.  Folders of the version before the current one
    stay for readers that have begun; those of older ones and of runs that died go.
    One writer at a time: a second one fails at the pointer.
    """
    now = current_version(spark, path)
    number = now.number + 1 if now else 1
    told = {"parts": dict(parts), "days": dict(days or {}), "buckets": buckets, "place": dict(place or {})}
    folders.write_new(spark, f"{path}/{POINTER}{number:012d}", json.dumps(told))
    keep = {*parts.values(), *(now.parts.values() if now else ())}
    for name in folders.names(spark, path):
        if name.startswith(POINTER) and int(name.removeprefix(POINTER)) < number - 1:
            folders.remove(spark, f"{path}/{name}")
        elif name.startswith(VERSION) and name not in keep:
            used = {folder.removeprefix(f"{name}/") for folder in keep if folder.startswith(f"{name}/")}
            for part in folders.names(spark, f"{path}/{name}") if used else ():
                if "=" in part and part not in used:
                    folders.remove(spark, f"{path}/{name}/{part}")
            if not used:
                folders.remove(spark, f"{path}/{name}")


def new_version() -> str:
    """A folder name that no other version has."""
    return f"{VERSION}{uuid.uuid4().hex}"


def replace_table(df: DataFrame, table: str, path: str, days: Mapping[str, str] | None = None) -> Audit:
    """Replace a table by a new version, which may be computed from the current one.

    ``days`` is kept with the version.
    """
    folder = new_version()
    audit = overwrite_table(df, table, f"{path}/{folder}")
    publish(df.sparkSession, path, {"": folder}, days)
    return Audit(table, path, audit.rows_written)


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def replace_buckets(
    df: DataFrame,
    table: str,
    path: str,
    key: Sequence[str],
    buckets: int,
    days: Mapping[str, str] | None = None,
    kept: Mapping[str, str] | None = None,
) -> Audit:
    """A new version in which the buckets of ``df``'s keys hold the rows of ``df``, and ``kept`` parts stay as they are.

    Only ``df`` is written: a folder for each of its buckets.
    """
    spark = df.sparkSession
    folder = new_version()
    rows, observation = counted(df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET))
    rows.write.option("partitionOverwriteMode", "static").mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/{folder}")
    written = [n for n in folders.names(spark, f"{path}/{folder}") if n.startswith(f"{BUCKET}=")]
    parts = {n.removeprefix(f"{BUCKET}="): f"{folder}/{n}" for n in written}
    publish(spark, path, dict(kept or {}) | parts, days, buckets)
    return Audit(table, path, observation.get["rows"])
