"""Removes passages of words that a document with a smaller id holds too.

Super-k-mers.  A window is 50 consecutive words; its minimiser is the twelve of
them with the smallest hash (the leftmost of equal ones), which depends on the
window's words only.  Consecutive windows with one minimiser are a super-k-mer,
about twenty windows in seventy words.  A bucket is a minimiser's hash; equal
windows meet in one bucket.

Counting.  First only the super-k-mers' names travel: bucket, 128 bits of the words,
place.  Buckets of one document are done with.  In a bucket whose super-k-mers are
all equal, every window has the bucket's smallest id.  From the other buckets one of
each kind of super-k-mer travels as a packed string, with its smallest and largest id,
and a task sorts the windows of whole buckets: equal ones, compared word by word,
get the smallest id of their kinds.  A window goes from the rows with a larger id.

Skew.  Names are aggregated by bucket map-side, copies by kind.  A bucket of
more than 8,192 super-k-mers is not sorted by a task: its windows are counted by
128 bits each, also map-side first, and the result is the same.  All joins read
tables that were written, so adaptive execution may split a hot bucket or kind.
Texts are shuffled once, by name.

Defined results: a null or blank text has no words; a text shorter than a window
loses nothing; windows of one id, in one row or several, don't hit each other; rows
without an id lose nothing and hit nothing; an empty table gives an empty table;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake import folders

from .common import named_rows, written, written_at
from .word_codes import digests, ragged, release_memory, slices, split_words

WINDOW = 50
GRAM = 12
#: Buckets with more super-k-mers are not sorted in one task.
MOST = 8192
SLICE = 2 << 20
#: Words looked at together, and bits for a place among them.
PIECE = 1 << 20
INDEX_BITS = 21
#: Windows compared at once.
AT_ONCE = 1 << 15
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
UNIT = "key long, print_a long, print_b long, doc_id long, name_a long, name_b long, run long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _gram_hashes(hashed: np.ndarray, gram: int) -> np.ndarray:
    n = len(hashed) - gram + 1
    out = np.zeros(n, U)
    for k in range(gram):
        out = out * BASE + hashed[k : k + n]
    return _mixed(out)


def super_kmers(
    hashed: np.ndarray, begins: np.ndarray, ends: np.ndarray, window: int = WINDOW, gram: int = GRAM
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, last window) of the super-k-mers in the texts hashed[begins[i]:ends[i]]."""
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    if len(hashed) < window:
        return none
    wide = window - gram + 1
    value = _gram_hashes(hashed, gram)
    n, mask = len(value), U((1 << INDEX_BITS) - 1)
    padded = np.full(-(-n // wide) * wide, U(0xFFFFFFFFFFFFFFFF))
    padded[:n] = (value & ~mask) | np.arange(n, dtype=U)
    rows = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(hashed) - window + 1
    chosen = (np.minimum(back[:starts], ahead[wide - 1 : wide - 1 + starts]) & mask).astype(np.int64)
    at = ragged(begins, np.maximum(0, ends - begins - window + 1)).astype(np.int64)
    if not len(at):
        return none
    place = chosen[at]
    head = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)))
    tail = np.append(head[1:], len(at)) - 1
    return value[place[head]].view(np.int64), at[head], at[tail]


class Packed:
    """A slice of texts as words and as one string, in which one space is between words."""

    def __init__(self, texts: pa.Array) -> None:
        self.codes, self.distinct, self.counts = split_words(texts)
        self.ends = np.cumsum(self.counts)
        self.begins = self.ends - self.counts

    def strings(self) -> tuple[bytes, np.ndarray]:
        """(all words, where each begins, and after the last one)."""
        lengths = pc.binary_length(self.distinct).to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.append(0, np.cumsum(lengths[self.codes] + 1))
        spelled = self.distinct.cast(pa.binary()).take(pa.array(self.codes))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(spelled)], pa.int32()), spelled), b" ")[0].as_py() or b"", offsets

    def hashed(self) -> np.ndarray:
        return hash_array(self.distinct.to_numpy(zero_copy_only=False).astype(object), categorize=False)[self.codes]

    def pieces(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first word, begins, ends) of parts that hold every window once."""
        if len(self.codes) <= PIECE:
            yield 0, self.begins, self.ends
            return
        for begin, end in zip(self.begins.tolist(), self.ends.tolist(), strict=True):
            for a in range(begin, max(begin + 1, end - WINDOW + 1), PIECE):
                yield a, np.zeros(1, np.int64), np.array([min(end, a + PIECE + WINDOW - 1) - a])


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The name of each super-k-mer: bucket, print, row, and a run of first window and number of windows."""
    for batch in batches:
        for at, texts in slices(batch.column("text"), SLICE):
            packed = Packed(texts)
            if packed.counts.max(initial=0) < WINDOW:
                continue
            hashed, (raw, offsets) = packed.hashed(), packed.strings()
            for base, begins, ends in packed.pieces():
                key, low, high = super_kmers(hashed[base : base + int(ends[-1])], begins, ends)
                low, high = low + base, high + base
                row = np.searchsorted(packed.ends, low, "right")
                rows = pa.array(row + at)
                prints = digests(raw, offsets[low], offsets[high + WINDOW] - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key),
                        pa.array(prints[:, 0]),
                        pa.array(prints[:, 1]),
                        *(batch.column(c).take(rows) for c in ("doc_id", "name_a", "name_b")),
                        pa.array((low - packed.begins[row]) << 8 | (high - low + 1)),
                    ],
                    names=["key", "print_a", "print_b", "doc_id", "name_a", "name_b", "run"],
                )
    release_memory()


KIND = ("key", "print_a", "print_b", "least", "most", "many")


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed string of each wanted super-k-mer."""
    for batch in batches:
        for at, texts in slices(batch.column("text"), SLICE):
            packed = Packed(texts)
            raw, offsets = packed.strings()
            wanted = batch.column("kinds").slice(at, len(texts))
            row = pc.list_parent_indices(wanted).to_numpy(zero_copy_only=False).astype(np.int64)
            kind = pc.list_flatten(wanted)
            run = pc.struct_field(kind, "run").to_numpy(zero_copy_only=False)
            low = packed.begins[row] + (run >> 8)
            begins, ends = offsets[low], offsets[low + (run & 0xFF) + WINDOW - 1] - 1
            step = 20_000
            for x in range(0, len(run), step):
                parts = [raw[a:b] for a, b in zip(begins[x : x + step].tolist(), ends[x : x + step].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(pc.struct_field(kind, c).slice(x, step) for c in KIND), pa.array(parts, pa.binary()).cast(pa.string())],
                    names=[*KIND, "packed"],
                )
    release_memory()


def _runs_where(active: np.ndarray, value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of runs of active places with one value and owner."""
    change = np.flatnonzero((value[1:] != value[:-1]) | (owner[1:] != owner[:-1]) | (active[1:] != active[:-1])) + 1
    first = np.append(0, change)
    last = np.append(change, len(value)) - 1
    return first[active[first]], last[active[first]]


def equal_windows(codes: np.ndarray, start: np.ndarray, hashed: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, first of each class) of windows of words, sorted so that equal ones stand together."""
    order = np.argsort(hashed, kind="stable")
    same = hashed[order][1:] == hashed[order][:-1]
    pairs = np.flatnonzero(same)
    far = np.arange(window)
    for x in range(0, len(pairs), AT_ONCE):
        some = pairs[x : x + AT_ONCE]
        a, b = (codes[start[order[some + k]][:, None] + far] for k in (0, 1))
        if (a != b).any():
            # Different windows of one hash: sort the words themselves.
            table = codes[start[:, None] + far]
            order = np.lexsort(table.T)
            same = (table[order][1:] == table[order][:-1]).all(axis=1)
            break
    return order, np.flatnonzero(np.append(True, ~same))


def _judge_buckets(rows: pa.Table) -> pa.RecordBatch:
    """Runs of windows of each kind, and the smallest id that holds them, where a row of the kind has a larger one."""
    packed = Packed(rows.column("packed").combine_chunks())
    counts = packed.counts - WINDOW + 1
    start = ragged(packed.begins, counts).astype(np.int64)
    kind = np.repeat(np.arange(len(counts)), counts)
    hashed = _gram_hashes(packed.hashed(), WINDOW)[start]
    order, first = equal_windows(packed.codes, start, hashed, WINDOW)
    least, most = (rows.column(c).to_numpy() for c in ("least", "most"))
    smallest = np.empty(len(start), np.int64)
    sizes = np.diff(np.append(first, len(order)))
    smallest[order] = np.repeat(np.minimum.reduceat(least[kind[order]], first), sizes)
    low, high = _runs_where(smallest < most[kind], smallest, kind)
    own = pa.array(kind[low])
    begin = start[low] - packed.begins[kind[low]]
    return pa.RecordBatch.from_arrays(
        [
            *(rows.column(c).combine_chunks().take(own) for c in ("key", "print_a", "print_b")),
            pa.array(begin),
            pa.array(begin + high - low),
            pa.array(smallest[low]),
        ],
        names=["key", "print_a", "print_b", "first", "last", "least"],
    )


def _judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole buckets at a time, from rows sorted by bucket."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column("key").to_numpy()
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))
        if cut or held and held[-1].column("key")[-1].as_py() != key[0]:
            held.append(batch.slice(0, cut))
            held = [x for x in held if len(x)]
            if held:
                yield _judge_buckets(pa.Table.from_batches(held))
            held = []
        held.append(batch.slice(cut))
    if held:
        yield _judge_buckets(pa.Table.from_batches(held))
    release_memory()


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128 bits of each window of a kind."""
    for batch in batches:
        for at in range(0, len(batch), 512):
            some = batch.slice(at, 512)
            packed = Packed(some.column("packed"))
            raw, offsets = packed.strings()
            counts = packed.counts - WINDOW + 1
            start = ragged(packed.begins, counts).astype(np.int64)
            kind = np.repeat(np.arange(len(counts)), counts)
            prints = digests(raw, offsets[start], offsets[start + WINDOW] - 1)
            rows = pa.array(kind)
            yield pa.RecordBatch.from_arrays(
                [
                    *(some.column(c).take(rows) for c in ("key", "print_a", "print_b", "least", "most")),
                    pa.array(start - packed.begins[kind]),
                    pa.array(prints[:, 0]),
                    pa.array(prints[:, 1]),
                ],
                names=["key", "print_a", "print_b", "least", "most", "first", "window_a", "window_b"],
            )
    release_memory()


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of their spans."""
    for batch in batches:
        for at, texts in slices(batch.column("text"), SLICE):
            packed = Packed(texts)
            spans = pc.fill_null(batch.column("spans").slice(at, len(texts)), [])
            row = pc.list_parent_indices(spans).to_numpy(zero_copy_only=False).astype(np.int64)
            change = np.zeros(len(packed.codes) + 1, np.int64)
            for field, step in (("start", 1), ("stop", -1)):
                np.add.at(change, packed.begins[row] + pc.struct_field(pc.list_flatten(spans), field).to_numpy(), step)
            stays = np.cumsum(change[:-1]) == 0
            owner = np.repeat(np.arange(len(texts)), packed.counts)
            left = np.bincount(owner[stays], minlength=len(texts))
            offsets = pa.array(np.append(0, np.cumsum(left)).astype(np.int32))
            words = packed.distinct.take(pa.array(packed.codes[stays]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(at, len(texts)),
                    pc.binary_join(pa.ListArray.from_arrays(offsets, words), " "),
                    pa.array(packed.counts),
                    pa.array(packed.counts - left),
                ],
                names=["doc_id", "kept", "n_words", "n_removed"],
            )
    release_memory()


def _same(*names: str):
    """Null-safe equality with the other side's ``_names``: both sides are shuffled for the join, so it can be split."""
    out = F.lit(True)
    for name in names:
        out = out & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return out


def _renamed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumnsRenamed({name: f"_{name}" for name in names})


def remove_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, kept (its words joined by spaces), n_words and n_removed of each row."""
    spark = docs.sparkSession
    source = named_rows(docs, doc_id, text)
    units, units_folder = written_at(source.where("doc_id IS NOT NULL").mapInArrow(_units, UNIT), "passage-units")
    buckets = written(
        units.groupBy("key")
        .agg(
            F.min("doc_id").alias("bucket_least"),
            F.max("doc_id").alias("bucket_most"),
            (F.min("print_a") != F.max("print_a")).alias("several"),
            (F.count(F.lit(1)) > MOST).alias("many"),
        )
        .where("bucket_least < bucket_most")
        .drop("bucket_most"),
        "passage-buckets",
    )
    hits = written(units.join(_renamed(buckets, "key"), _same("key")).drop("_key"), "passage-hits")
    folders.remove(spark, units_folder)
    kinds = (
        hits.where("several")
        .groupBy("key", "print_a", "print_b")
        .agg(
            F.min("doc_id").alias("least"),
            F.max("doc_id").alias("most"),
            F.first("many").alias("many"),
            # Any row that holds it will do; the smallest name needs the fewest texts.
            F.min(F.struct("name_a", "name_b", "run")).alias("place"),
        )
        .groupBy(F.col("place.name_a").alias("_name_a"), F.col("place.name_b").alias("_name_b"))
        .agg(F.collect_list(F.struct(*KIND, "place.run")).alias("kinds"))
    )
    packed = written(
        source.join(kinds, _same("name_a", "name_b"))
        .select("text", "kinds")
        .mapInArrow(_pack, "key long, print_a long, print_b long, least long, most long, many boolean, packed string"),
        "passage-strings",
    )
    judged = "key long, print_a long, print_b long, first long, last long, least long"
    few = packed.where("NOT many").drop("many").repartition("key").sortWithinPartitions("key").mapInArrow(_judge, judged)
    windows = packed.where("many").mapInArrow(
        _windows,
        "key long, print_a long, print_b long, least long, most long, first long, window_a long, window_b long",
    )
    smallest = windows.groupBy(F.col("window_a").alias("_window_a"), F.col("window_b").alias("_window_b")).agg(
        F.min("least").alias("smallest")
    )
    spread = (
        windows.join(smallest, _same("window_a", "window_b"))
        .where("smallest < most")
        .select("key", "print_a", "print_b", "first", F.col("first").alias("last"), F.col("smallest").alias("least"))
    )
    found = written(few.union(spread), "passage-judged")
    first, windows_of = F.shiftright("run", 8), F.col("run").bitwiseAND(F.lit(0xFF))
    all_equal = hits.where("NOT several AND doc_id > bucket_least").select(
        "name_a", "name_b", first.alias("start"), (first + windows_of + (WINDOW - 1)).alias("stop")
    )
    of_kind = (
        hits.where("several")
        .select("key", "print_a", "print_b", "doc_id", "name_a", "name_b", "run")
        .join(_renamed(found, "key", "print_a", "print_b"), _same("key", "print_a", "print_b"))
        .where("doc_id > least")
        .select("name_a", "name_b", (first + F.col("first")).alias("start"), (first + F.col("last") + WINDOW).alias("stop"))
    )
    spans = (
        all_equal.union(of_kind)
        .groupBy(F.col("name_a").alias("_name_a"), F.col("name_b").alias("_name_b"))
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    )
    return (
        source.join(spans, _same("name_a", "name_b"), "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_remove, "doc_id long, kept string, n_words long, n_removed long")
    )
