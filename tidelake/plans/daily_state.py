"""KPI states kept up to date by day, so that a KPI does not read history again.

A state has a partial table for each day of a table loaded by day, and one merged
table.  An update reads the days that are new or were written again, makes their
partials, and merges them into the merged table; the partials of a day that was
written again or taken away are retracted first, if the state can, or else all
partials are merged anew.  Older days themselves are not read.

Partials lie under their day and the print of the day's files, so those of a
day's old files are there until the new merged table is in force; a run that dies is
repeated with the same result.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake import folders
from tidelake.operators.guards import Audit
from tidelake.sinks.lake import replace_table
from tidelake.sources.lake import bronze_days, current_version, stored_scan, table_path
from tidelake.specs import LOAD_DATE, TableSpec

STAMP = "stamp"


class DistinctIds:
    """Exact distinct ids: a bitmap for each range of 32,768 ids.

    Ids that lie close, as running numbers do, take a bit each; scattered ones take a
    bitmap of their own, mostly zeros, which Parquet's compression makes small.
    Bitmaps can't be subtracted, so a rewritten day merges all partials again.
    """

    retracts = False

    def __init__(self, column: str) -> None:
        self.column = column
        self.schema = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("bitmap", T.BinaryType())])

    def partial(self, rows: DataFrame, *by: str) -> DataFrame:
        known = rows.where(F.col(self.column).isNotNull())
        bucket = F.bitmap_bucket_number(F.col(self.column).cast("long")).alias("bucket")
        place = F.bitmap_bit_position(F.col(self.column).cast("long"))
        return known.groupBy(*by, bucket).agg(F.bitmap_construct_agg(place).alias("bitmap"))

    def merged(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


class SumByKey:
    """Sums of a whole-numbered column by key; exact, so a day can be taken out again.

    A sum knows how many rows and how many known values it is of: a key without rows is
    gone, and one whose values are all NULL has a NULL sum, as in a plain sum.
    """

    retracts = True

    def __init__(self, key: str, value: str) -> None:
        self.key, self.value = key, value
        long = T.LongType()
        self.schema = T.StructType([T.StructField(c, long) for c in (key, value, "known", "rows")])

    def partial(self, rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy(*by, F.col(self.key).cast("long").alias(self.key)).agg(
            F.coalesce(F.sum(F.col(self.value).cast("long")), F.lit(0)).alias(self.value),
            F.count(self.value).alias("known"),
            F.count(F.lit(1)).alias("rows"),
        )

    def negative(self, partials: DataFrame) -> DataFrame:
        return partials.withColumns({c: -F.col(c) for c in (self.value, "known", "rows")})

    def merged(self, partials: DataFrame) -> DataFrame:
        sums = partials.groupBy(self.key).agg(*[F.sum(c).alias(c) for c in (self.value, "known", "rows")])
        return sums.where("rows <> 0")

    def sums(self, merged: DataFrame) -> DataFrame:
        return merged.select(self.key, F.when(F.col("known") > 0, F.col(self.value)).alias(self.value))


@dataclass(frozen=True)
class DailyState:
    """One state of one table loaded by day, below ``root``."""

    name: str
    spec: TableSpec
    kind: DistinctIds | SumByKey
    root: str

    @property
    def merged_path(self) -> str:
        return f"{self.root}/{self.name}/merged"

    def _folder(self, day: str, stamp: str) -> str:
        return f"{self.root}/{self.name}/days/{LOAD_DATE}={day}/{STAMP}={stamp}"

    def _partials(self, spark: SparkSession, days: Iterable[tuple[str, str]]) -> DataFrame:
        """Partials of (day, stamp); a day without any, all of its ids NULL, has no folder."""
        paths = [self._folder(*d) for d in days if folders.names(spark, self._folder(*d))]
        if not paths:
            return spark.createDataFrame([], self.kind.schema)
        return spark.read.schema(self.kind.schema).parquet(*paths)

    def _write_partials(self, spark: SparkSession, source: str, days: dict[str, str]) -> None:
        stamps = spark.createDataFrame([(date.fromisoformat(d), s) for d, s in days.items()], f"day DATE, {STAMP} STRING")
        rows = self.kind.partial(stored_scan(spark, self.spec, source, days), LOAD_DATE)
        (
            rows.join(stamps, F.col(LOAD_DATE) == F.col("day"))
            .drop("day")
            .hint("rebalance", LOAD_DATE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(LOAD_DATE, STAMP)
            .parquet(f"{self.root}/{self.name}/days")
        )

    def update(self, spark: SparkSession, tables_root: str) -> Audit:
        """Bring the state in line with ``<tables_root>/<table>``."""
        source = f"{tables_root}/{self.spec.name}"
        days = bronze_days(spark, self.spec, source)
        current = current_version(spark, self.merged_path)
        known = current.days if current else {}
        fresh = {d: s for d, s in days.items() if known.get(d) != s}
        stale = {d: s for d, s in known.items() if days.get(d) != s}
        if current is not None and not fresh and not stale:
            return Audit(self.name, self.merged_path, 0)
        if fresh:
            self._write_partials(spark, source, fresh)
        merged = spark.createDataFrame([], self.kind.schema)
        if current is not None:
            merged = spark.read.schema(self.kind.schema).parquet(table_path(spark, self.merged_path))
        if not stale:
            parts = [merged, self._partials(spark, fresh.items())]
        elif self.kind.retracts:
            parts = [merged, self._partials(spark, fresh.items()), self.kind.negative(self._partials(spark, stale.items()))]
        else:
            parts = [self._partials(spark, days.items())]
        audit = replace_table(self.kind.merged(reduce(DataFrame.unionByName, parts)), self.name, self.merged_path, days)
        for day, stamp in stale.items():
            folders.remove(spark, self._folder(day, stamp))
        return audit

    def read(self, spark: SparkSession) -> DataFrame:
        if current_version(spark, self.merged_path) is None:
            raise FileNotFoundError(f"state {self.name} was never updated in {self.root}")
        return spark.read.schema(self.kind.schema).parquet(table_path(spark, self.merged_path))

    def newest_day(self, spark: SparkSession) -> date | None:
        current = current_version(spark, self.merged_path)
        return date.fromisoformat(max(current.days)) if current and current.days else None


def total_orders(spark: SparkSession, state: DailyState) -> DataFrame:
    """``kpis.total_orders`` from a state of distinct order ids."""
    return state.read(spark).agg(
        F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("total_orders"),
        F.lit(state.newest_day(spark)).cast("date").alias("ref_date"),
    )


def units_sold(spark: SparkSession, state: DailyState) -> DataFrame:
    """Items summed by product, for ``kpis.top_products_sold``."""
    return state.kind.sums(state.read(spark))
