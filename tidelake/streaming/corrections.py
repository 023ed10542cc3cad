"""Orders that are corrected after they came: the latest version of each key, as a stream.

The table is the state.  It lies in buckets of its key, and a batch reads and writes
only the buckets that its keys are in, so nothing grows in a state store though
every key ever seen may still be corrected.  Late rows: the event time of a row
decides, not when it comes; a row older than the one kept for its key changes nothing,
however late it is, and no row is dropped by a watermark.  Of rows of one key and
event time the greatest is kept, comparing the other columns in order.  So the result
depends on the rows only, not on batches, and a batch that is repeated changes
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelake.plans.silver import merge_versions
from tidelake.specs import TableSpec


def keep_latest(
    spark: SparkSession,
    spec: TableSpec,
    version: str,
    feed: str,
    silver_root: str,
    checkpoint: str,
    buckets: int,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Merge the files of ``feed`` not seen yet into ``<silver_root>/<table>``, newest ``version`` per key."""

    def merge(batch: DataFrame, _batch_id: int) -> None:
        merge_versions(batch, spec, version, silver_root, buckets)

    reader = spark.readStream.schema(spec.schema)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return (
        reader.parquet(feed)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
