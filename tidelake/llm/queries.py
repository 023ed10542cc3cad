"""One query per operator: production parameters over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.workspace import new_folder

from . import (
    ball_tree,
    cover_tree,
    direct_codes,
    hyper_minhash,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    quality_rules,
    suffix_dedup,
    super_kmers,
    toxicity,
    transducer,
)
from .common import public_tokenizer, table

TOKEN_LIMIT = 4096


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizer("word_bpe_49k.json"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.where(~toxicity.in_fold("doc_id")))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.in_fold("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = new_folder(spark, "direct-codes")
    direct_codes.write(docs, folder, public_tokenizer("word_bpe_49k.json"))
    return direct_codes.read_documents(spark, folder)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op5_hyper_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hyper_minhash.near_duplicates(docs)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.clean_lines(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.taken(mixing.mix(docs))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = transducer.count_tokens(docs, public_tokenizer("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ball_tree.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    best = periodic_runs.exponent_first(F.col("runs"))
    line = lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    return (
        periodic_runs.collapse_runs(docs)
        .withColumn("best", best)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            "best.start",
            "best.length",
            "best.period",
            F.floor(F.lit(1000).cast("long") * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
            F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )


def op12_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return super_kmers.remove_passages(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op13_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return cover_tree.hard_negatives(rows, rows.where(F.col("vec_id") % 50 == 0))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_direct_codes": op3_direct_codes,
    "op4_line_dedup": op4_line_dedup,
    "op5_hyper_minhash": op5_hyper_minhash,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_ball_tree": op10_ball_tree,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_super_kmers": op12_super_kmers,
    "op13_cover_tree": op13_cover_tree,
}
