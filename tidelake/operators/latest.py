"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame,
    key: Sequence[str],
    version: str,
    ties: str = "all",
) -> DataFrame:
    """Keep the rows that carry their key's newest ``version``.

    Same rows as ``rank() over (partition by key order by version desc) = 1``:
    NULL keys form one group, a NULL version is the oldest, and rows tied on the
    newest version all stay.  ``ties="one"`` keeps the greatest of the tied rows
    instead, comparing the remaining columns in order.

    A window would bring every row of a key to one task.  Here the newest
    version per key is aggregated map-side first, and the rows meet it in a
    semi join on (key, version), whose kind is Spark's choice: few keys are
    broadcast, and the rows are not shuffled.  In a shuffle a hot key spreads
    over its versions, and a hot (key, version) is a skewed join partition,
    which adaptive execution splits, since the other side has one row for it.
    """
    if ties == "one":
        return _one_per_key(df, key, version)
    if ties != "all":
        raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")

    newest = df.groupBy(*key).agg(F.max(version).alias(version))
    return join_null_safe(df, newest, [*key, version], "left_semi")


def update_by_key(
    latest: DataFrame, newer: DataFrame, key: Sequence[str], version: str, ties: str = "all"
) -> DataFrame:
    """``latest_by_key`` of both, where every row of ``newer`` is newer than all of ``latest``.

    Needs ``latest`` to be the latest rows already, and ``newer`` to be the
    latest of the newer rows.  These then all stay, so they are not shuffled;
    only their distinct keys are, to find the old rows that none of them
    replaces.
    """
    if ties == "one":
        newer = _one_per_key(newer, key, version)
    untouched = join_null_safe(latest, newer.select(*key).distinct(), key, "left_anti")
    return untouched.unionByName(newer)


def join_null_safe(rows: DataFrame, keys: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Join on columns of the same names where NULL equals NULL; those of ``keys`` are dropped.

    ``keys`` comes from an aggregation by some of ``names``.  Null-safe equality
    makes Spark shuffle it anew for the join, and both inputs of the join being
    shuffles is what lets adaptive execution split a skewed one.
    """
    keys = keys.withColumnsRenamed({name: f"other_{name}" for name in names})
    same = [rows[name].eqNullSafe(keys[f"other_{name}"]) for name in names]
    return rows.join(keys, reduce(and_, same), how).drop(*[f"other_{name}" for name in names])


def _one_per_key(df: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    others = [c for c in df.columns if c not in key and c != version]
    picked = df.groupBy(*key).agg(F.max(F.struct(version, *others)).alias("picked"))
    return picked.select(*[c if c in key else f"picked.{c}" for c in df.columns])
