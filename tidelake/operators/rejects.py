"""Rows with malformed values: told apart from the others, with the reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.specs import TableSpec

ERRORS = "errors"
OUT_OF_RANGE, MALFORMED = "out of range", "malformed"
ERROR = "array<struct<column:string,text:string,reason:string>>"
#: Types whose values are numbers, and those that hold fewer of them.
NARROW = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DecimalType)


def _error(field: T.StructField) -> Column:
    """What is wrong with a column's value; NULL if it can be cast, or is NULL."""
    column = F.col(f"`{field.name}`")
    text = column.cast("string")
    number = text.try_cast("double")
    # A number that is no value of a narrower type: too large, or not whole.
    reason = F.lit(MALFORMED)
    if isinstance(field.dataType, NARROW):
        fits = number.isNotNull() & ~F.isnan(number) & (number == F.floor(F.greatest(F.least(number, F.lit(9e18)), F.lit(-9e18))))
        reason = F.when(fits | (F.abs(number) > 9e18), F.lit(OUT_OF_RANGE)).otherwise(reason)
    wrong = column.isNotNull() & column.try_cast(field.dataType).isNull()
    return F.when(wrong, F.struct(F.lit(field.name).alias("column"), text.alias("text"), reason.alias("reason")))


def with_errors(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with ``errors``: what of each row can't be cast to its column's declared type."""
    fields = [f for f in spec.schema.fields if df.schema[f.name].dataType != f.dataType]
    found = F.array_compact(F.array(*[_error(f) for f in fields])) if fields else F.array()
    return df.withColumn(ERRORS, found.cast(ERROR))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(ERRORS) == 0).drop(ERRORS)


def rejected(checked: DataFrame, *keep: str) -> DataFrame:
    """One row for each row that has errors: ``errors``, the columns ``keep``, and the others as JSON of texts."""
    names = [c for c in checked.columns if c not in (ERRORS, *keep)]
    row = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in names]), {"ignoreNullFields": "false"})
    return checked.where(F.size(ERRORS) > 0).select(ERRORS, row.alias("row"), *keep)
