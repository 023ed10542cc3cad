"""Contract checks and row counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidelake.specs import LOAD_DATE, TableSpec


class ContractError(ValueError):
    """A table does not have what its load mode needs."""


@dataclass(frozen=True)
class Audit:
    """What a load did."""

    table: str
    path: str
    rows_written: int
    rows_rejected: int = 0
    fingerprint: Decimal | None = None

    @property
    def written(self) -> bool:
        return self.rows_written > 0


def require_contract(df: DataFrame, spec: TableSpec) -> DataFrame:
    """An incremental load needs the load date, a full load needs a key."""
    if LOAD_DATE not in df.columns:
        raise ContractError(f"{spec.name}: column '{LOAD_DATE}' is missing")
    if not spec.incremental:
        if not spec.key:
            raise ContractError(f"{spec.name}: a full load needs a primary key")
        missing = [c for c in spec.key if c not in df.columns]
        if missing:
            raise ContractError(f"{spec.name}: key columns {missing} are missing")
    return df


def counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """Count rows in the same pass that consumes ``df``.

    The count is ``rows``; each keyword counts the rows that satisfy its
    condition.  No shuffle should lie between this and the action: rows of a
    shuffle that runs again after a lost executor are counted again.
    """
    observation = Observation()
    measures = {"rows": F.count(F.lit(1))} | {
        name: F.count_if(condition) for name, condition in counts.items()
    }
    return (
        df.observe(observation, *[m.alias(name) for name, m in measures.items()]),
        observation,
    )


def row_print(columns: Sequence[str]) -> Column:
    """64 bits of a row; a NULL differs from every value, and from a NULL of another column."""
    parts = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(*parts)


def fingerprinted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``counted``, with ``fingerprint``: the sum of all rows' prints.

    It does not depend on the order of rows or on files, and tells how often a row is
    there.  Columns count by name order; the types must be the same to compare.
    """
    observation = Observation()
    total = F.sum(row_print(sorted(df.columns)).cast("decimal(20,0)")).cast("decimal(38,0)")
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), total.alias("fingerprint")), observation
