"""Drops lines that many documents share.

Each document's distinct normalised lines are exploded and hashed, the documents
are counted per hash, lines of a hash over the threshold go, and the rest of a
text is joined again in its order.  Only built-in expressions are used.

Skew: a line is shuffled once per document as (hash, id), then counted with
partial aggregation, so a line of a third of all documents is one row per task.
The lines meet the few hashes over the threshold in a join that shuffles both
sides, so adaptive execution can split it at a hot line (tested).  Texts are shuffled once, with the hashes to drop.

Defined results: a null or empty text is one empty line and stays as it is; rows
of one doc_id count as one document (null ids as one that is smaller than all
others), and each of them is cleaned; an empty table gives an empty table.
Columns of the result replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, null_safe, strip_spaces

MIN_DOCUMENTS = 5
MIN_CHARS = 40


def line_key(line: Column) -> Column:
    return ascii_lower(strip_spaces(line))


def line_hash(line: Column) -> Column:
    """128 bits of a line's key; keys that differ in any character differ in it."""
    return F.unhex(F.md5(line_key(line)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def repeated_lines(docs: DataFrame, min_documents: int, min_chars: int, doc_id: str, text: str) -> DataFrame:
    """Id (__tl_doc) and hashes (__tl_drop): the hashes of the lines each document loses."""
    long_lines = F.filter(_lines(F.col(text)), lambda x: F.length(strip_spaces(x)) >= min_chars)
    held = (
        docs.select(
            F.col(doc_id).alias("__tl_doc"),
            F.explode(F.array_distinct(F.transform(long_lines, line_hash))).alias("__tl_line"),
        )
        .groupBy("__tl_line", "__tl_doc")
        .agg(F.lit(1).alias("__tl_one"))
    )
    spread = (
        held.groupBy("__tl_line")
        .agg(F.count("__tl_one").alias("__tl_documents"), F.max("__tl_doc").alias("__tl_keeper"))
        .where(F.col("__tl_documents") >= min_documents)
        .select("__tl_line", "__tl_keeper")
    )
    spread, same = null_safe(spread, "__tl_line")
    return (
        held.join(spread, same)
        .where(~F.col("__tl_doc").eqNullSafe(F.col("__tl_keeper")))
        .groupBy("__tl_doc")
        .agg(F.collect_list("__tl_line").alias("__tl_drop"))
    )


def drop_repeated_lines(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """All columns of ``docs``, its text without repeated lines, and n_lines, n_dropped.

    A line is compared without spaces at its ends and with A-Z in lower case.  The
    largest id that holds a repeated line keeps it.
    """
    drops = repeated_lines(docs, min_documents, min_chars, doc_id, text)
    joined = docs.join(drops, F.col(doc_id).eqNullSafe(F.col("__tl_doc")), "left")
    all_lines = _lines(F.col(text))
    stays = F.filter(
        all_lines,
        lambda x: (F.length(strip_spaces(x)) < min_chars) | ~F.array_contains(F.col("__tl_drop"), line_hash(x)),
    )
    out = joined.withColumn("__tl_kept", F.when(F.col("__tl_drop").isNotNull(), stays))
    n_lines = F.size(all_lines).cast("long")
    return out.withColumns(
        {
            "n_lines": n_lines,
            "n_dropped": F.when(F.col("__tl_kept").isNull(), F.lit(0)).otherwise(n_lines - F.size("__tl_kept")).cast("long"),
            text: F.when(F.col("__tl_kept").isNull(), F.col(text)).otherwise(F.array_join("__tl_kept", "\n")),
        }
    ).drop("__tl_doc", "__tl_drop", "__tl_kept")
