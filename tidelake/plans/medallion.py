"""A whole run: every table to bronze and silver, then the KPIs."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidelake.operators.guards import Audit
from tidelake.plans import bronze, gold, silver
from tidelake.sources.lake import silver_tables
from tidelake.specs import SALES, TableSpec


def run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    lake_root: str,
    run_date: date,
    specs: Mapping[str, TableSpec] = SALES,
    backfill_from: date | None = None,
) -> list[Audit]:
    """Run all layers for one run date.

    Running a date again changes nothing.  With ``backfill_from``, incremental
    tables load every day from it up to the run date.
    """
    bronze_root, silver_root = f"{lake_root}/bronze", f"{lake_root}/silver"
    audits = []
    for name, spec in specs.items():
        if not spec.incremental:
            audits.append(bronze.load(sources[name], spec, bronze_root, run_date))
            audits.append(silver.refresh(spark, spec, bronze_root, silver_root, run_date))
        elif backfill_from is not None:
            audits.append(bronze.backfill(sources[name], spec, bronze_root, backfill_from, run_date))
            audits.append(
                silver.incremental(spark, spec, bronze_root, silver_root, backfill_from, run_date)
            )
        else:
            audits.append(bronze.load(sources[name], spec, bronze_root, run_date))
            audits.append(silver.incremental(spark, spec, bronze_root, silver_root, run_date))
    gold.build(silver_tables(spark, silver_root, dict(specs)), f"{lake_root}/gold", run_date)
    return audits
