"""What the operators of this folder share: words, spaces, tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.workspace import new_folder

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def strip_spaces(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words(text: Column) -> Column:
    """Runs of characters that are not spaces; none for a blank text."""
    bare = strip_spaces(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN, -1))


def finite_vector(vector: Column) -> Column:
    """Whether a vector and all of its components are there and finite."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )


def null_safe(df: DataFrame, *names: str) -> tuple[DataFrame, Column]:
    """``df`` with ``_`` before the names, and the condition that they equal those of the other side of a join.

    NULL equals NULL.  Such a join shuffles both sides anew, though ``df`` was aggregated
    by the names, and so adaptive execution can split it at a hot key.
    """
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return df.withColumnsRenamed({name: f"_{name}" for name in names}), same


def row_digest(*columns: Column) -> Column:
    """MD5 (hex) of all values of a row; null differs from every value, and no two lists of values run together."""
    strings = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in strings]
    return F.md5(F.concat(*parts).cast("binary"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the folder that all executors share, read back.

    It cuts the lineage: what follows needs the files only, also after the loss
    of an executor.
    """
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``written``, and the folder, for a table that is removed when another stands in for it."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


#: Ids are told apart by so many buckets, which bounds what is broadcast.
ID_BUCKETS = 1 << 18


def named_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, name_a and name_b: two numbers that tell rows apart, except rows equal in id and text.

    An id of one row is its name.  Rows of other ids, and without one, are named by 128
    bits of id and text; an id that shares its bucket with a repeated one too.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(ID_BUCKETS))
    repeated = source.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    shared = written(repeated.select(bucket.alias("_bucket")).distinct(), "repeated-ids")
    alone = F.col("doc_id").isNotNull() & F.col("_bucket").isNull()
    digest = row_digest(F.col("doc_id"), F.col("text"))
    first, second = (F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17))
    # At most a row for each bucket.
    return source.join(F.broadcast(shared), bucket == F.col("_bucket"), "left").select(
        "doc_id",
        "text",
        F.when(alone, F.col("doc_id")).otherwise(first).alias("name_a"),
        F.when(alone, F.lit(0).cast("long")).otherwise(second).alias("name_b"),
    )


def public_tokenizer(name: str) -> str:
    """Where the vocabulary file ``name`` is; it is read there and never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)
