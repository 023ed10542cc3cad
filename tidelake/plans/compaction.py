"""Many small day folders to few files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidelake import folders
from tidelake.sinks.lake import new_version, publish
from tidelake.sources.lake import COMPACTED, bronze_days, compacted_version, folder_days, stored_scan
from tidelake.specs import LOAD_DATE, TableSpec

TARGET_BYTES = 256 << 20


def day_sizes(spark: SparkSession, root: str) -> dict[str, int]:
    """Bytes of each day folder; Spark lists the files, and a row for each day comes back."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    day = F.regexp_extract("path", rf"/{LOAD_DATE}=([^/]+)/[^/]+$", 1)
    sizes = files.load(root).select(day.alias("day"), "length").where("day <> ''")
    return {r["day"]: r["bytes"] for r in sizes.groupBy("day").agg(F.sum("length").alias("bytes")).collect()}


def packed_days(sizes: dict[str, int], target: int) -> dict[str, int]:
    """Day to bin: days in order fill a bin up to ``target`` bytes, so that a bin is a range of days.

    A day that is larger than a bin stays as it is.  The bins are then as even as the
    days allow: their number is the least, and each takes its share of the bytes.
    """
    small = [d for d in sorted(sizes) if sizes[d] <= target]
    total = sum(sizes[d] for d in small)
    share = total / max(1, -(-total // target))
    bins, n, used = {}, 0, 0
    for day in small:
        if used and (used + sizes[day] > target or used + sizes[day] / 2 > share):
            n, used = n + 1, 0
        bins[day] = n
        used += sizes[day]
    return bins


def compact(spark: SparkSession, spec: TableSpec, root: str, upto: date, target: int = TARGET_BYTES) -> int:
    """Bring the day folders up to a day into files of about ``target`` bytes; the number of files.

    The files lie beside the day folders, under a version pointer, sorted by day, so
    that a day's rows are found by the files' statistics.  A day folder counts before
    them: until the folders are removed, after the switch, and when a day is written
    again, the scans read the folder.  Days keep their prints, so what was made from
    them is not made again.  Remove-while-read is the user's to avoid: compact days
    that no reader has just begun to read.
    """
    path = f"{root}/{COMPACTED}"
    there = folder_days(spark, root)
    sizes = {d: n for d, n in day_sizes(spark, root).items() if d in there and d <= upto.isoformat()}
    bins = packed_days(sizes, target)
    if len(bins) < 2:
        return 0
    prints, current = bronze_days(spark, spec, root), compacted_version(spark, root)
    folder = new_version()
    table = spark.createDataFrame([(date.fromisoformat(d), n) for d, n in bins.items()], "day DATE, bin INT")
    n_bins = max(bins.values()) + 1
    (
        stored_scan(spark, spec, root, bins)
        .join(table, F.col(LOAD_DATE) == F.col("day"))
        .drop("day")
        .repartition(n_bins, "bin")
        .sortWithinPartitions("bin", LOAD_DATE)
        .write.option("partitionOverwriteMode", "static")
        .mode("overwrite")
        .partitionBy("bin")
        .parquet(f"{path}/{folder}")
    )
    parts = {f"{folder}/{n}": f"{folder}/{n}" for n in folders.names(spark, f"{path}/{folder}") if n.startswith("bin=")}
    place = {d: f"{folder}/bin={n}" for d, n in bins.items()}
    days = {d: prints[d] for d in bins}
    if current is not None:
        place = {d: p for d, p in current.place.items() if d not in place} | place
        days = {d: s for d, s in current.days.items() if d not in days} | days
        parts |= {p: p for p in set(place.values())}
    publish(spark, path, parts, days, place=place)
    for day in bins:
        folders.remove(spark, f"{root}/{LOAD_DATE}={day}")
    return len(set(place.values()))
