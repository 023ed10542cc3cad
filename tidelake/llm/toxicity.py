"""Toxicity scores by a counterfactually regularised linear classifier.

Features are a text's distinct words without the signs around them, and the
first letters of those words.  The classifier is a logistic regression with a
sparse penalty.  For each labelled text that names a group of people, the group
terms are swapped for every other of their kind in turn, and the change of the score
is penalised, so that a neutral mention of a group says nothing.  (The given tables
name no group; a test plants neutral mentions and a label bias.)

Bounds, all parameters: the fit sees about ``max_rows`` labelled rows, taken by a
hash of their id, and ``max_features`` features, those that tell the labels apart
best among them.  Scoring covers all texts, each by itself; nothing but the
weights goes to the tasks.

Defined results: a null or empty text has no features and gets the score of the
intercept; rows with a null id are scored and not held out; labels that are null
or without a text are not used; without any label the score is 0, and with labels
of one kind only the intercept tells.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .word_codes import release_memory, slices, split_words

MAX_ROWS = 16_000
MAX_FEATURES = 20_000
MIN_TOXIC = 3
#: How much a change of score under swapped terms counts.
COUNTERFACTUAL = 10.0
#: First letters of words, as features of their own.
PREFIXES = (4, 5)
SIGNS = re.compile(r"^\W+|\W+$")
#: Terms of one line stand for groups of one kind and can be swapped.
GROUP_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "transgender"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("disabled", "blind", "deaf"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)
TERMS = frozenset(term for kind in GROUP_TERMS for term in kind)
Kinds = Sequence[Sequence[str]]


def swaps(kinds: Kinds) -> list[dict[str, str]]:
    """The n-th swap takes each term to the n-th one after it in its kind, until all have been in the place of all."""
    longest = max((len(kind) for kind in kinds), default=0)
    return [
        {term: kind[(i + n) % len(kind)] for kind in kinds if n < len(kind) for i, term in enumerate(kind)}
        for n in range(1, longest)
    ]


def word_features(word: str, terms: Container[str] = TERMS) -> tuple[str, ...]:
    """The features of a space-separated word; a group term has no first letters."""
    bare = SIGNS.sub("", word).lower()
    if not bare:
        return ()
    if bare in terms:
        return (bare,)
    return (bare, *(f"{bare[:n]}*" for n in PREFIXES if len(bare) > n))


def text_features(texts: pa.Array, terms: Container[str] = TERMS) -> Iterator[set[str]]:
    """The features of each text."""
    coded, distinct, counts = split_words(texts)
    by_word = [word_features(w, terms) for w in distinct.to_pylist()]
    at = 0
    for n in counts.tolist():
        yield {f for w in np.unique(coded[at : at + n]).tolist() for f in by_word[w]}
        at += n


def _feature_counts(terms: frozenset[str]):
    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
                labels = batch.column("toxic").slice(at, len(texts)).to_pylist()
                for label, features in zip(labels, text_features(texts, terms), strict=True):
                    seen[label].update(features)
                names = list(seen[0] | seen[1])
                yield pa.RecordBatch.from_pydict(
                    {"feature": names, "clean": [seen[0][f] for f in names], "toxic": [seen[1][f] for f in names]},
                    schema=pa.schema([("feature", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]),
                )
        release_memory()

    return counted


def _design(chosen: dict[str, int], kinds: Kinds):
    """Places of each text's chosen features, and of those after its group terms are swapped, one list for each swap."""
    terms, by_turn = frozenset(t for kind in kinds for t in kind), swaps(kinds)

    def design(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                own, swapped = [], []
                for features in text_features(texts, terms):
                    own.append(sorted(chosen[f] for f in features if f in chosen))
                    others = [{swap.get(f, f) for f in features} for swap in by_turn if not features.isdisjoint(swap)]
                    swapped.append([sorted(chosen[f] for f in other if f in chosen) for other in others])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("toxic").slice(at, len(texts)),
                        pa.array(own, pa.list_(pa.int32())),
                        pa.array(swapped, pa.list_(pa.list_(pa.int32()))),
                    ],
                    names=["toxic", "own", "swapped"],
                )

    return design


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows], np.int64)
    return np.repeat(np.arange(len(rows)), lengths), np.array([i for r in rows for i in r], np.int64)


def fit(
    labels: np.ndarray,
    own: list[list[int]],
    swapped: list[list[list[int]]],
    n_features: int,
    sparse: float = 1e-4,
    counterfactual: float = COUNTERFACTUAL,
    rounds: int = 400,
) -> tuple[float, np.ndarray]:
    """(intercept, weights) by full-batch steps of adaptive size with soft thresholds.

    ``counterfactual`` times the mean square of the score's change under a text's swaps
    is added to the loss.
    """
    row, col = _sparse(own)
    pairs = [(o, s) for o, many in zip(own, swapped, strict=True) for s in many]
    share = np.array([1 / len(many) for many in swapped for _ in many])
    plus, minus = _sparse([o for o, _ in pairs]), _sparse([s for _, s in pairs])
    n = len(labels)
    toxic = (labels.sum() + 0.5) / (n + 1)
    bias, weights = float(np.log(toxic / (1 - toxic))), np.zeros(n_features)
    mean, square = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, rounds + 1):
        logits = bias + np.bincount(row, weights[col], n)
        error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / n
        slope = np.bincount(col, error[row], n_features)
        if pairs:
            change = np.bincount(plus[0], weights[plus[1]], len(pairs))
            change -= np.bincount(minus[0], weights[minus[1]], len(pairs))
            change *= 2 * counterfactual / n * share
            slope += np.bincount(plus[1], change[plus[0]], n_features)
            slope -= np.bincount(minus[1], change[minus[0]], n_features)
        whole = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * whole
        square = 0.999 * square + 0.001 * whole**2
        rate = 0.1 if step < 0.7 * rounds else 0.02
        pace = rate / (np.sqrt(square / (1 - 0.999**step)) + 1e-6)
        move = pace * mean / (1 - 0.9**step)
        bias -= move[-1]
        weights -= move[:-1]
        weights = np.sign(weights) * np.maximum(0, np.abs(weights) - pace[:-1] * sparse)
    return float(bias), weights


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_ROWS,
    max_features: int = MAX_FEATURES,
    kinds: Kinds = GROUP_TERMS,
    counterfactual: float = COUNTERFACTUAL,
):
    """(intercept, {feature: weight}, group terms) from ``labels`` (doc_id, toxic) and the texts of ``docs``.

    About ``max_rows`` ids, chosen by a hash, are fitted on, however often an id is in
    either table: it has the larger of its labels and one of its texts.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    n = known.count()
    if not n:
        return None
    part = F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(min(1.0, max_rows / n) * (1 << 20))
    # The rows kept are bounded by max_rows, so they can be sent to every task.
    texts = written(
        docs.select(F.col("doc_id"), F.col("text").cast("string"))
        .join(F.broadcast(known.where(part)), F.col("doc_id") == F.col("_id"))
        .groupBy("_id", "toxic")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .select("text", "toxic"),
        "toxicity-sample",
    )
    terms = frozenset(t for kind in kinds for t in kind)
    counts = texts.mapInArrow(_feature_counts(terms), "feature string, clean long, toxic long")
    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_clean, n_toxic = max(1, totals.get(0, 0)), max(1, totals.get(1, 0))
    gap = F.abs(F.col("toxic") / n_toxic - F.col("clean") / n_clean)
    telling = (
        counts.groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= MIN_TOXIC)
        .withColumn("gap", gap / F.sqrt(F.col("toxic") + F.col("clean")))
        .orderBy(F.col("gap").desc(), "feature")
        .limit(max_features)
    )
    names = sorted({*(r["feature"] for r in telling.select("feature").collect()), *terms})
    chosen = {f: i for i, f in enumerate(names)}
    rows = texts.mapInArrow(_design(chosen, kinds), "toxic int, own array<int>, swapped array<array<int>>").toArrow()
    y = np.array(rows["toxic"].to_pylist(), np.float64)
    if not len(y):
        return None
    own, swapped = rows["own"].to_pylist(), rows["swapped"].to_pylist()
    # In one order, whatever the order of the rows was, so that a rerun sums alike.
    order = sorted(range(len(y)), key=lambda i: (own[i], y[i]))
    own, swapped = [own[i] for i in order], [swapped[i] for i in order]
    bias, weights = fit(y[order], own, swapped, len(names), counterfactual=counterfactual)
    return bias, {f: float(w) for f, w in zip(names, weights, strict=True) if w}, terms


Model = tuple[float, dict[str, float], frozenset[str]]


def _scorer(model: Model | None):
    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, weights, terms = model or (None, {}, TERMS)
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                coded, distinct, counts = split_words(texts)
                features = [tuple(f for f in word_features(w, terms) if f in weights) for w in distinct.to_pylist()]
                telling = np.array([bool(f) for f in features], bool)
                owner = np.repeat(np.arange(len(texts)), counts)
                hits = telling[coded] if len(coded) else np.zeros(0, bool)
                scores = np.zeros(len(texts))
                found: dict[int, set[str]] = {}
                for i, w in zip(owner[hits].tolist(), coded[hits].tolist(), strict=True):
                    found.setdefault(i, set()).update(features[w])
                if bias is not None:
                    sums = [bias + sum(weights[f] for f in sorted(found.get(i, ()))) for i in range(len(texts))]
                    scores = 1 / (1 + np.exp(-np.clip(np.array(sums), -50, 50)))
                rest = batch.slice(at, len(texts))
                columns = [*rest.columns, pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*rest.schema.names, "score"])
        release_memory()

    return scored


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` and the score of each row's text; it replaces a column of that name."""
    source = docs.drop("score")
    schema = T.StructType([*source.schema.fields, T.StructField("score", T.DoubleType())])
    return source.mapInArrow(_scorer(model), schema)


def in_fold(doc_id: str, folds: int = 5):
    """The held-out fifth, by a checksum of the id; null ids are not in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))
