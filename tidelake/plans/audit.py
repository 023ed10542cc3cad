"""Whether two layers hold the same rows, from prints that the loads took while writing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake import folders
from tidelake.operators.guards import Audit

AUDIT = "layer string, table string, first date, last date, rows long, fingerprint decimal(38,0), number int"


def record(spark: SparkSession, audits_root: str, layer: str, audit: Audit, first: date, last: date) -> None:
    """Keep what a load wrote for ``first..last``; a later record of the same days counts before an earlier one."""
    path = f"{audits_root}/{layer}-{audit.table}-{first}-{last}"
    number = len(folders.names(spark, path))
    entry = (layer, audit.table, first, last, audit.rows_written, audit.fingerprint, number)
    spark.createDataFrame([entry], AUDIT).coalesce(1).write.parquet(f"{path}/{number:08d}")


def audited(spark: SparkSession, audits_root: str) -> DataFrame:
    """Loads of the same table and days in two layers, and whether they hold the same rows."""
    entries = spark.read.schema(AUDIT).option("recursiveFileLookup", "true").parquet(audits_root)
    newest = entries.groupBy("layer", "table", "first", "last").agg(
        F.max_by("rows", "number").alias("rows"), F.max_by("fingerprint", "number").alias("fingerprint")
    )

    def of(layer: str) -> DataFrame:
        own = newest.where(F.col("layer") == layer)
        return own.select("table", "first", "last", F.col("rows").alias(f"{layer}_rows"), F.col("fingerprint").alias(f"{layer}_print"))

    both = of("bronze").join(of("silver"), ["table", "first", "last"])
    same = (F.col("bronze_rows") == F.col("silver_rows")) & F.col("bronze_print").eqNullSafe(F.col("silver_print"))
    return both.select("table", "first", "last", "bronze_rows", "silver_rows", same.alias("same"))
