"""Incremental bronze-to-silver ingest as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelake.sinks.lake import write_days
from tidelake.sources.lake import stored_scan
from tidelake.specs import LOAD_DATE, TableSpec


def replace_touched_days(
    spark: SparkSession,
    spec: TableSpec,
    bronze_root: str,
    silver_root: str,
    checkpoint: str,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Bring silver's days in line with bronze for every day with new files.

    The stream tells which days have new files; each batch reads these days from
    bronze, whatever types they are stored in, and overwrites them in silver.  So
    rewritten days and repeated batches leave no duplicates, and silver is a plain
    table that batch loads may write too.

    ``max_files_per_batch`` bounds what a batch has to look at, at a price: a day whose
    files fall into several batches is read and written once for each of them.
    """
    bronze, silver = f"{bronze_root}/{spec.name}", f"{silver_root}/{spec.name}"

    def replace(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        # One value per calendar day, whatever the batch holds.
        days = [row[LOAD_DATE].isoformat() for row in batch.select(LOAD_DATE).distinct().collect()]
        if days:
            write_days(stored_scan(session, spec, bronze, days), spec.name, silver, days="many")

    reader = spark.readStream.schema(T.StructType([T.StructField(LOAD_DATE, T.DateType())]))
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return (
        reader.parquet(bronze)
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
