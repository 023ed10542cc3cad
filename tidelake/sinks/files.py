"""Text and CSV writers; one file per partition."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidelake.sources.files import CSV_QUOTING


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_positional_csv(df: DataFrame, path: str) -> None:
    """CSV whose header is the column positions ``0,1,2,...``."""
    positions = [str(i) for i in range(len(df.columns))]
    df.toDF(*positions).write.mode("overwrite").csv(path, header=True, **CSV_QUOTING)
