"""Validity intervals of keyed rows, from dated snapshots.

A history row is a row as one or more snapshots in sequence held it:

``valid_from``  the first of these snapshots
``last_seen``   the last of them
``valid_to``    the next snapshot that held its key, or NULL: from that day on it is
                not valid; a key that is gone from the source keeps its last rows
``copies``      how many equal rows each of the snapshots held

Rows that stay the same take one history row however many snapshots there are.
Several rows of a key in one snapshot are valid side by side, as rank() = 1 keeps
them all.  No step brings the rows of a key to one task: only days per key, and
days per different row, are put in order, and there are as many as snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.operators.latest import join_null_safe
from tidelake.specs import LOAD_DATE

FROM, SEEN, TO, COPIES = "valid_from", "last_seen", "valid_to", "copies"
DATE = T.DateType()


def history_schema(schema: T.StructType) -> T.StructType:
    days = [T.StructField(name, DATE) for name in (FROM, SEEN, TO)]
    return T.StructType([*schema.fields, *days, T.StructField(COPIES, T.LongType())])


def _day_before(day: Column, days: Sequence[date]) -> Column:
    """The snapshot day before ``day``; the days of a calendar are a small map."""
    known = [F.lit(d).cast("date") for d in days]
    pairs = [x for before, d in zip(known, known[1:], strict=False) for x in (d, before)]
    return F.try_element_at(F.create_map(*pairs), day) if pairs else F.lit(None).cast("date")


def intervals(snapshots: DataFrame, key: Sequence[str], days: Sequence[date], version: str = LOAD_DATE) -> DataFrame:
    """The history of all ``snapshots``; ``days`` are the days on which there was one, in order."""
    columns = [c for c in snapshots.columns if c != version]
    held = snapshots.groupBy(*columns, version).agg(F.count(F.lit(1)).alias(COPIES))
    in_order = Window.partitionBy(*columns, COPIES).orderBy(version)
    before = F.lag(version).over(in_order)
    begins = ~before.eqNullSafe(_day_before(F.col(version), days)) | before.isNull()
    runs = (
        held.withColumn("begins", begins.cast("int"))
        .withColumn("run", F.sum("begins").over(in_order))
        .groupBy(*columns, COPIES, "run")
        .agg(F.min(version).alias(FROM), F.max(version).alias(SEEN))
        .drop("run")
    )
    of_key = Window.partitionBy(*key).orderBy(SEEN)
    key_days = (
        snapshots.groupBy(*key, F.col(version).alias(SEEN)).agg(F.lit(1).alias("one")).withColumn(TO, F.lead(SEEN).over(of_key))
    )
    return join_null_safe(runs, key_days.drop("one"), [*key, SEEN], "left").select(*columns, FROM, SEEN, TO, COPIES)


def extended(
    open_rows: DataFrame, snapshot: DataFrame, key: Sequence[str], day: date, day_before: date | None, version: str = LOAD_DATE
) -> DataFrame:
    """The history rows that ``snapshot``, the first one after all of ``open_rows``, makes of them and of its own.

    ``open_rows`` are those without ``valid_to``.  Keys that are not in the snapshot
    are passed on unshuffled; rows that it repeats are prolonged; the others end,
    and new ones begin.
    """
    columns = [c for c in snapshot.columns if c != version]
    keys = snapshot.select(*key).distinct()
    untouched = join_null_safe(open_rows, keys, key, "left_anti")
    today, none = F.lit(day).cast("date"), F.lit(None).cast("date")
    old = join_null_safe(open_rows, keys, key, "left_semi").select(
        *columns, COPIES, F.col(FROM).alias("old_from"), F.col(SEEN).alias("old_seen"), F.lit(0).alias("new")
    )
    new = (
        snapshot.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias(COPIES))
        .select(*columns, COPIES, none.alias("old_from"), none.alias("old_seen"), F.lit(1).alias("new"))
    )
    # A key's open rows were last seen on one day, so equal ones are one row.
    met = old.unionByName(new).groupBy(*columns, COPIES)
    met = met.agg(F.max("old_from").alias("old_from"), F.max("old_seen").alias("old_seen"), F.max("new").alias("new"))

    def row(start: Column, seen: Column, end: Column) -> Column:
        return F.struct(start.alias(FROM), seen.alias(SEEN), end.alias(TO))

    is_new, was = F.col("new") == 1, F.col("old_from").isNotNull()
    prolonged = is_new & was & F.col("old_seen").eqNullSafe(F.lit(day_before).cast("date"))
    begun, ended = row(today, today, none), row(F.col("old_from"), F.col("old_seen"), today)
    now = (
        F.when(prolonged, F.array(row(F.col("old_from"), today, none)))
        .when(is_new & was, F.array(ended, begun))
        .when(is_new, F.array(begun))
        .otherwise(F.array(ended))
    )
    changed = met.withColumn("now", F.explode(now)).select(*columns, f"now.{FROM}", f"now.{SEEN}", f"now.{TO}", COPIES)
    return untouched.select(*columns, FROM, SEEN, TO, COPIES).unionByName(changed)


def valid_on(day: Column) -> Column:
    return (F.col(FROM) <= day) & (F.col(TO).isNull() | (day < F.col(TO)))


def as_of(history: DataFrame, day: date, days: Sequence[date], version: str = LOAD_DATE) -> DataFrame:
    """The latest rows per key of the snapshots up to ``day``, with their snapshot's day.

    Equal to ``latest_by_key`` of these snapshots.  A plain filter: no shuffle.
    """
    columns = [c for c in history.columns if c not in (FROM, SEEN, TO, COPIES)]
    newest = max((d for d in days if d <= day), default=None)
    rows = history.where(valid_on(F.lit(day).cast("date")))
    seen = F.least(F.col(SEEN), F.lit(newest).cast("date")).alias(version)
    return _repeated(rows.select(*columns, seen, COPIES))


def as_of_join(facts: DataFrame, history: DataFrame, on: str, day: str) -> DataFrame:
    """Each fact with the rows of its key that were valid on the fact's own ``day``.

    Facts without such a row drop out.  An equality join on the key, whose kind is
    Spark's choice; a hot key of the facts is a skewed partition that adaptive
    execution splits, as the history is read from files.
    """
    columns = [c for c in history.columns if c not in (FROM, SEEN, TO, COPIES, on)]
    versions = history.withColumnRenamed(on, "history_key")
    joined = facts.join(versions, (F.col(on) == F.col("history_key")) & valid_on(F.col(day)))
    return _repeated(joined.select(*facts.columns, *columns, COPIES))


def _repeated(rows: DataFrame) -> DataFrame:
    times = F.explode(F.array_repeat(F.lit(1), F.col(COPIES).cast("int")))
    once, more = rows.where(F.col(COPIES) == 1), rows.where(F.col(COPIES) > 1)
    return once.drop(COPIES).unionByName(more.withColumn("copy", times).drop(COPIES, "copy"))
