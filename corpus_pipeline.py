"""The corpus pipeline: five stages over ``documents``, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and gives a table, which is written as
Parquet in the shared folder and read again as the next stage's docs.  All but the
last give rows of ``documents`` with its columns.

Toxic documents go; lines that many documents share stay in one of them (a text
can become shorter, no document goes); one document of each group of near
duplicates stays; the mix draws documents up to three times, or not at all, as the
sources' weights ask; the last stage packs what is drawn into sequences.

Defined results: rows with a null text or id pass the first three stages as they
are; an empty table gives an empty table at every stage; columns beside those of
``documents`` are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import hyper_minhash, line_dedup, mixing, packing, toxicity
from tidelake.llm.common import public_tokenizer, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near-duplicate stages work on five words and a similarity of 0.8.
SHINGLE, PERCENT = 5, 80
#: The last stage's workers live beside what the stages before it left in memory.
SLICE_BYTES, REMEMBERED = 1 << 20, 100_000


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not call toxic."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.where(~toxicity.in_fold("doc_id")))
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("score") < 0.5).select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that five or more of them share; n_chars of what is left."""
    out = line_dedup.drop_repeated_lines(docs)
    cut = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", cut).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    found = hyper_minhash.judged(docs, percent=PERCENT, shingle=SHINGLE)
    # Of rows with one id, each is judged by its own text, and goes by itself.
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("__tl_gone"), F.col("body").alias("__tl_body")).distinct()
    same = (F.col("doc_id") == F.col("__tl_gone")) & (hyper_minhash.body(F.col("text")) == F.col("__tl_body"))
    return docs.join(gone, same, "left_anti").select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix draws them, shard by shard."""
    return mixing.drawn_documents(docs, mixing.mix(docs)).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, public_tokenizer("word_bpe_49k.json"), slice_bytes=SLICE_BYTES, remembered=REMEMBERED)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: No SQL: tokens, the classifier and hash orders are not of SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
