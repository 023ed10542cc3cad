"""Ordered limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; planned as a per-partition heap, not a full sort."""
    return df.orderBy(*order).limit(k)


#: So many times k rows are tried first; a few may have no partner.
TRIED = 4


def top_k_before_join(
    rows: DataFrame,
    names: DataFrame,
    on: str,
    by: str,
    then_by: Sequence[str],
    k: int,
) -> DataFrame:
    """The rows of ``top_k_joined``, for two sides that are both too large to broadcast.

    The value of the 4k-th row is a scalar subquery; only rows from it on, ties
    included, are joined first.  If they give k joined rows, these are the top, as all
    other rows are lower; otherwise the other rows are joined too.  It is one lazy
    plan: the other rows stand behind a filter on the number found, so they are
    scanned, but not shuffled, unless they are needed.  It scans ``rows`` some times
    more than the plain plan, which is why that one serves where ``names`` is small.
    """
    wanted = [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in (*then_by, on)]]
    wanted += [F.col(c).asc_nulls_first() for c in names.columns if c != on]
    known = rows.where(F.col(by).isNotNull() & F.col(on).isNotNull())
    cut = known.select(by).orderBy(F.col(by).desc()).limit(TRIED * k).agg(F.min(by)).scalar()
    high = F.col(by) >= cut
    first = rows.where(high).join(names, on)
    found = first.select(F.lit(1).alias("one")).limit(k).agg(F.count("one")).scalar()
    rest = rows.where((found < k) & ~F.coalesce(high, F.lit(False))).join(names, on)
    return top_k(first.unionByName(rest), wanted, k)


def top_k_joined(
    rows: DataFrame,
    names: DataFrame,
    on: str,
    by: str,
    then_by: Sequence[str],
    k: int,
) -> DataFrame:
    """Top ``k`` of ``rows JOIN names`` by ``by`` descending, NULLs last.

    Ties are broken by ``then_by``, the join column and the columns of
    ``names``, in this order.  One plan for every size: Spark chooses the join,
    and each task keeps a heap of ``k`` joined rows.
    """
    order = [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in (*then_by, on)]]
    order += [F.col(c).asc_nulls_first() for c in names.columns if c != on]
    return top_k(rows.join(names, on), order, k)
