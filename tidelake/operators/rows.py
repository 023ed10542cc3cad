"""Row-wise operators: projection, casts, load-date stamp, day filters, masking."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.columns import masked
from tidelake.specs import LOAD_DATE, TableSpec


def select_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*spec.columns)


def stabilize_types(df: DataFrame, spec: TableSpec, lenient: bool = False) -> DataFrame:
    """Cast the table's columns to their declared types.

    A malformed value raises; with ``lenient`` it becomes NULL.
    """

    def cast(column: Column, data_type) -> Column:
        return column.try_cast(data_type) if lenient else column.cast(data_type)

    return df.withColumns(
        {
            field.name: cast(F.col(field.name), field.dataType)
            for field in spec.schema.fields
            if df.schema[field.name].dataType != field.dataType
        }
    )


def stamp_load_date(df: DataFrame, run_date: date) -> DataFrame:
    return df.withColumn(LOAD_DATE, F.lit(run_date).cast("date"))


def on_run_date(df: DataFrame, spec: TableSpec, run_date: date) -> DataFrame:
    """Rows whose text day column is exactly the run date.

    A value with a time part does not match.  The plain equality on the source
    column is what lets Spark push it into the source.
    """
    return df.where(F.col(spec.day_column) == run_date.isoformat())


def on_run_dates(df: DataFrame, spec: TableSpec, first: date, last: date) -> DataFrame:
    """Rows that some run in ``first..last`` would load, stamped with its date.

    The text bounds reach the source; the round trip through DATE keeps only
    exact ``yyyy-MM-dd`` texts, as the equality of the daily run does.
    """
    text = F.col(spec.day_column)
    day = text.try_cast("date")
    return df.where(
        text.between(first.isoformat(), last.isoformat()) & (day.cast("string") == text)
    ).withColumn(LOAD_DATE, day)


def mask_columns(df: DataFrame, *names: str) -> DataFrame:
    """Replace whole columns by the mask, a header line read as data included."""
    return df.withColumns({name: masked() for name in names})
