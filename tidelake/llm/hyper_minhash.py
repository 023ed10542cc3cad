"""Near-duplicate classes by HyperMinHash sketches, confirmed on whole sets.

A document is the set of its distinct word shingles.  A sketch has 128 buckets;
each keeps its smallest hash as a leading-zero count and ten bits of mantissa.
Small sets fill empty buckets by further rounds of hashing, which keeps the
chance that two buckets agree at the Jaccard similarity.  32 bands of four
registers make candidates: a pair at 0.85 is missed with a chance of 6e-11, one at
0.8 with 5e-8.

Documents with equal sets are one class from the start, so any number of copies
is one row.  In each bucket the class that meets most others is paired with the
rest; pairs whose collision-corrected estimate, by a longer sketch, can reach the
threshold are confirmed on whole sets.  Where a bucket then still spans several components, all
its pairs across components are estimated, in blocks of bounded size, and
confirmed likewise.  So no pair of candidates is passed over but those that are
linked already.  Nothing is collected; labels spread over tables in the shared
folder.

Defined results: a text without words, or null, has an empty set and is linked
with nothing; fewer words than a shingle make one shingle; rows without an id
stay by themselves, with a null component, and are kept; rows of one id are
linked each by its own text; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import null_safe, row_digest, written
from .components import connected
from .word_codes import release_memory, slices, split_words

REGISTERS = 128
BANDS, ROWS = 32, 4
MANTISSA = 10
#: A set element is the upper 52 bits of a shingle's hash, so that a slice sorts as (document, element).
ELEMENT_BITS = 52
ROWS_AT_ONCE = 1 << (64 - ELEMENT_BITS)
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: Registers of one byte in a wide sketch, and the chance that two different ones agree.
WIDE = 1024
COLLISION = 1 / 256 + 1 / (3 * 2**MANTISSA)
SIGMAS = 5
BLOCK = 512


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted elements of all sets in row order, size of each row's set)."""
    coded, distinct, counts = split_words(pc.ascii_lower(texts))
    if not len(coded):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    words = hash_array(distinct.to_numpy(zero_copy_only=False).astype(object), categorize=False)[coded]
    owner = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(counts)[owner]
    left = ends - np.arange(len(words))
    first = np.arange(len(words)) == ends - counts[owner]
    #: A shingle begins at each word with enough words after it, or at the first of a short text.
    here = np.flatnonzero((left >= size) | (first & (left < size)))
    value = np.zeros(len(here), np.uint64)
    for k in range(size):
        inside = left[here] > k
        part = words[np.minimum(here + k, len(words) - 1)] * MIX[k % len(MIX)] + np.uint64(k + 1)
        value = np.where(inside, mixed(value ^ part), value)
    element = (owner[here].astype(np.uint64) << np.uint64(ELEMENT_BITS)) | (value >> np.uint64(64 - ELEMENT_BITS))
    element = np.sort(element)
    element = element[np.append(True, element[1:] != element[:-1])]
    sizes = np.bincount((element >> np.uint64(ELEMENT_BITS)).astype(np.int64), minlength=len(texts))
    return element & np.uint64((1 << ELEMENT_BITS) - 1), sizes.astype(np.int64)


def registers(elements: np.ndarray, sizes: np.ndarray, buckets: int = REGISTERS) -> np.ndarray:
    """A row of 16-bit registers for each set; zeros for an empty one.  ``buckets`` is a power of two."""
    n, bits = len(sizes), 64 - (buckets.bit_length() - 1)
    low = np.uint64((1 << bits) - 1)
    least = np.full(n * buckets, np.uint64(0xFFFFFFFFFFFFFFFF))
    round_of = np.zeros(n * buckets, np.uint16)
    owner = np.repeat(np.arange(n), sizes)
    rest = np.ones(len(elements), bool)
    turn = 0
    while rest.any():
        owner, elements = owner[rest], elements[rest]
        turn += 1
        value = mixed(elements + np.uint64(turn * int(MIX[0]) & (1 << 64) - 1))
        bucket = owner * buckets + (value >> np.uint64(bits)).astype(np.int64)
        empty = round_of[bucket] == 0
        np.minimum.at(least, bucket[empty], value[empty] & low)
        round_of[bucket[empty]] = turn
        open_rows = (round_of.reshape(n, buckets) == 0).any(axis=1)
        rest = open_rows[owner]
    # Leading zeros of the hash, and the mantissa bits after its first one.
    lead = np.clip(bits - np.ceil(np.log2(least.astype(np.float64) + 1)).astype(np.int64), 0, bits)
    shifted = (least << np.minimum(lead + 1, bits).astype(np.uint64)) & low
    mantissa = (shifted >> np.uint64(bits - MANTISSA)).astype(np.int64)
    packed = (lead << MANTISSA | mantissa).astype(np.uint64)
    # A bucket filled in a later round agrees only with one of the same round.
    packed = (packed + round_of.astype(np.uint64) * np.uint64(0x9E37)) & np.uint64(0xFFFF)
    packed[round_of == 0] = 0
    return packed.astype("<u2").reshape(n, buckets)


def wide_sketches(elements: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A longer sketch, of registers hashed to one byte, for estimates before a whole set is read."""
    return (mixed(registers(elements, sizes, WIDE).astype(np.uint64)) & np.uint64(0xFF)).astype(np.uint8)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    keys = np.empty((len(sketches), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(sketches), band + 1, np.uint64)
        for k in range(ROWS):
            key = mixed(key * MIX[1] + sketches[:, band * ROWS + k].astype(np.uint64))
        keys[:, band] = key
    return keys.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of wide sketches, less the agreements that are due to chance."""
    agreed = np.count_nonzero(a == b, axis=-1) / a.shape[-1]
    return np.maximum(0, (agreed - COLLISION) / (1 - COLLISION))


def lowest_estimate(percent: int, n: int) -> float:
    """By ``n`` registers, one pair at the threshold in millions is estimated lower."""
    at = percent / 100
    return at - SIGMAS * float(np.sqrt(at * (1 - at) / n))


def may_reach(others: np.ndarray, one: np.ndarray, percent: int) -> np.ndarray:
    """Which of the wide sketches may be that similar: a first part is looked at, then all of it."""
    some = np.flatnonzero(estimate(others[:, :REGISTERS], one[:REGISTERS]) >= lowest_estimate(percent, REGISTERS))
    return some[estimate(others[some], one) >= lowest_estimate(percent, WIDE)]


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for batch in batches:
        for at, texts in slices(batch.column("text")):
            for start in range(0, len(texts), ROWS_AT_ONCE):
                some = texts.slice(start, ROWS_AT_ONCE)
                yield batch.slice(at + start, len(some)), some
    release_memory()


def _prints(raw: bytes, sizes: np.ndarray) -> pa.Array:
    """128 bits of each set; null for an empty one."""
    ends = np.cumsum(sizes)
    return pa.array(
        [
            hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None
            for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)
        ],
        pa.binary(),
    )


def _sketches(size: int):
    def sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _rows(batches):
            elements, sizes = shingle_sets(texts, size)
            sketch = registers(elements, sizes)
            prints = _prints(elements.astype("<u8").tobytes(), sizes)
            keys = pa.ListArray.from_arrays(
                pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(band_keys(sketch).ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("body"), pa.array(sizes), prints, keys],
                names=["doc_id", "body", "n_shingles", "print", "bands"],
            )

    return sketched


def _whole_sets(size: int):
    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _rows(batches):
            elements, sizes = shingle_sets(texts, size)
            sketch = wide_sketches(elements, sizes)
            keys = band_keys(registers(elements, sizes))
            ends = np.cumsum(sizes)
            raw = elements.astype("<u8").tobytes()
            whole = [raw[8 * a : 8 * b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    _prints(raw, sizes),
                    pa.array(whole, pa.binary()),
                    pa.array([s.tobytes() for s in sketch], pa.binary()),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                ],
                names=["print", "whole", "sketch", "bands"],
            )

    return sets


def _confirm(percent: int):
    least = lowest_estimate(percent, WIDE)

    def confirmed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, p, q in zip(*(batch.column(c) for c in ("whole_a", "whole_b", "sketch_a", "sketch_b")), strict=True):
                pair = [np.frombuffer(s.as_py(), np.uint8) for s in (p, q)]
                if estimate(*pair) < least:
                    keep.append(False)
                    continue
                a, b = (np.frombuffer(s.as_py(), "<u8") for s in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirmed


def _across(percent: int):
    """Pairs of one block pair that are in different components and may reach the threshold.

    Rows come sorted by block pair; a block pair is whole before it is looked at.
    """
    group = ["key", "low", "high"]

    def pairs_of(pdf: pd.DataFrame) -> pd.DataFrame:
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), WIDE)
        bands = np.frombuffer(b"".join(pdf["bands"]), np.int64).reshape(len(pdf), BANDS)
        key = pdf["key"].to_numpy(np.int64)
        rep, component, part = (pdf[c].to_numpy(np.int64) for c in ("rep", "component", "part"))
        low, high = pdf["low"].to_numpy(np.int64), pdf["high"].to_numpy(np.int64)
        out = []

        def near(i: int, others: np.ndarray) -> None:
            others = others[component[others] != component[i]]
            # A pair is looked at in the first of the bands that it shares.
            first = (bands[others] == bands[i]).argmax(axis=1)
            others = others[bands[i][first] == key[i]]
            if len(others):
                close = others[may_reach(sketch[others], sketch[i], percent)]
                out.extend((min(rep[i], r), max(rep[i], r)) for r in rep[close].tolist())

        cuts = _cuts(pdf[group])
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            here = np.arange(start, stop)
            names, sizes = np.unique(component[here], return_counts=True)
            # A pair across components has a row outside the largest one.
            few = component[here] != names[sizes.argmax()]
            if low[start] == high[start]:
                for i in here[few].tolist():
                    near(i, here[~few | (here > i)])
                continue
            left, right = part[here] == low[start], part[here] == high[start]
            for i in here[left & few].tolist():
                near(i, here[right])
            for i in here[right & few].tolist():
                near(i, here[left & ~few])
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    def across(pdfs: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in pdfs:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            last = int(_cuts(pdf[group])[-2]) if len(pdf) else 0
            yield pairs_of(pdf.iloc[:last])
            held = pdf.iloc[last:]
        if held is not None and len(held):
            yield pairs_of(held)

    return across


def _cuts(keys: pd.DataFrame) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    values = keys.to_numpy(np.int64)
    changed = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
    return np.concatenate([[0], changed, [len(values)]]) if len(values) else np.zeros(1, np.int64)


def near_duplicates(
    docs: DataFrame, percent: int = 85, shingle: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row: the smallest id of a component is kept."""
    return judged(docs, percent, shingle, doc_id, text).drop("body")


def body(text: Column) -> Column:
    """128 bits of a text, which tell the rows of one id apart."""
    return F.unhex(row_digest(text.cast("string")))


def judged(
    docs: DataFrame, percent: int = 85, shingle: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """What ``near_duplicates`` says of each row, and the ``body`` of its text."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = written(
        source.withColumn("body", body(F.col("text"))).mapInArrow(
            _sketches(shingle), "doc_id long, body binary, n_shingles long, print binary, bands array<long>"
        ),
        "minhash-sketches",
    )
    # One row for each different set, with its smallest id; numbers stand for prints, as the table is written once.
    classes = written(
        rows.where(F.col("print").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("print")
        .agg(F.min("doc_id").alias("least_id"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "minhash-classes",
    )
    in_bands = classes.where(F.col("n") >= 1).select("rep", F.explode("bands").alias("key"))
    shared = in_bands.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared, same = null_safe(shared, "key")
    buckets = written(in_bands.join(shared, same).drop("_key"), "minhash-buckets")
    reach = buckets.groupBy("rep").agg(F.sum("members").alias("reach"))
    meets = buckets.join(reach, "rep")
    pivots = meets.groupBy("key").agg(F.max_by("rep", F.struct("reach", -F.col("rep"))).alias("pivot"))
    pivots, same = null_safe(pivots, "key")
    stars = (
        meets.join(pivots, same)
        .where("rep <> pivot")
        .select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))
        .distinct()
    )
    # A class's set comes from any row with its id and print; other texts of that id go by their print.
    needed = classes.join(reach.select("rep"), "rep", "left_semi").select("rep", "least_id", F.col("print").alias("_print"))
    sets = written(
        source.join(needed, F.col("doc_id") == F.col("least_id"), "left_semi")
        .mapInArrow(_whole_sets(shingle), "print binary, whole binary, sketch binary, bands binary")
        .join(needed.select("rep", "_print"), F.col("print") == F.col("_print"))
        .drop("print", "_print")
        .dropDuplicates(["rep"]),
        "minhash-sets",
    )

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        def side(c: str) -> DataFrame:
            return sets.select(
                F.col("rep").alias(f"_{c}"), F.col("whole").alias(f"whole_{c}"), F.col("sketch").alias(f"sketch_{c}")
            )

        both = pairs.join(side("a"), F.col("a") == F.col("_a")).join(side("b"), F.col("b") == F.col("_b"))
        return written(both.drop("_a", "_b").mapInArrow(_confirm(percent), "a long, b long"), name)

    links = confirmed(stars, "minhash-star-links")
    label = connected(links)
    known = buckets.join(label, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "members", F.coalesce("component", "rep").alias("component")
    )
    mixed_keys = known.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"))
    mixed_keys = mixed_keys.where("_lo <> _hi").select("key")
    parts = F.ceil(F.col("members") / BLOCK)
    mixed_keys, same = null_safe(mixed_keys, "key")
    open_rows = (
        known.join(mixed_keys, same)
        .join(sets.select(F.col("rep").alias("_doc"), "sketch", F.col("bands").alias("own_bands")), F.col("rep") == F.col("_doc"))
        .withColumn("part", F.pmod(F.xxhash64("rep"), parts))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .select(
            "key",
            "rep",
            "component",
            "sketch",
            F.col("own_bands").alias("bands"),
            "part",
            F.least("part", "_other").alias("low"),
            F.greatest("part", "_other").alias("high"),
        )
    )
    block_pairs = open_rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    rest = written(block_pairs.mapInPandas(_across(percent), "a long, b long").distinct(), "minhash-rest")
    more = confirmed(rest, "minhash-more-links")
    components = connected(links.union(more))
    # A component goes by the smallest id in it.
    linked = classes.select("rep", "least_id").join(components, F.col("rep") == F.col("node"))
    smallest = linked.groupBy(F.col("component").alias("_component")).agg(F.min("least_id").alias("_least"))
    ids = components.join(smallest, F.col("component") == F.col("_component")).select("node", "_least")
    of_print = classes.join(ids, F.col("rep") == F.col("node"), "left").select(
        F.col("print").alias("_print"), F.coalesce("_least", "least_id").alias("component")
    )
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.join(of_print, F.col("print") == F.col("_print"), "left").select(
        "doc_id",
        "body",
        "n_shingles",
        component_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"),
    )
