"""Finds periodic runs of words, and keeps one period of each.

Dictionary of basic factors.  At level k every place of a text has a name for the
2^k words that begin there; a name of the next level stands for a pair of names.
Only factors that occur twice in their text go on, so a text without repeats ends
after a level or two.  The places of a name, in order, are its successor
occurrences.  Where three of them or more stand at equal distances of over 2^k and
at most 2^(k+1) words (at level 0, of one or two), the progression proposes its
distance as a period: a run of at least four periods holds a factor of that length
which occurs once in each period, so no run is missed.  The names of all levels
then give how far the proposal reaches on both sides, and equal stretches go by
their smallest period.

A text is looked at by itself, in slices of many texts; nothing is shuffled.  The
names of a long text take four bytes for each word and level in which it still
repeats itself.

Defined results: a null, empty or blank text has no words and no runs; a null id
and a repeated one are rows like others; an empty table gives an empty table;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words
from .word_codes import ragged, release_memory, slices, split_words

MIN_LENGTH = 6
MIN_PERIODS = 4
SLICE = 2 << 20
FOUND = "doc_id {}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _by_name(name: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names, places) sorted by name, then place; places come in ascending order."""
    bits = int(place[-1]).bit_length()
    if int(name.max()).bit_length() + bits < 64:
        both = np.sort(name << bits | place)
        return both >> bits, both & ((1 << bits) - 1)
    order = np.argsort(name, kind="stable")
    return name[order], place[order]


def basic_factors(codes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, names of all places, names, places) level by level.

    The names of all places have -1 for a factor that its text holds once; the
    last two are those of the others, sorted by name and place.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(np.cumsum(counts), counts)
    n, length, longest = len(codes), 1, int(counts.max(initial=0))
    place = np.arange(n)
    name = owner * (int(codes.max(initial=0)) + 1) + codes
    while len(place) and (length == 1 or 4 * length < longest):
        name, place = _by_name(name, place)
        first = np.append(True, name[1:] != name[:-1])
        number = np.cumsum(first) - 1
        repeated = np.bincount(number)[number] > 1
        name, place = number[repeated], place[repeated]
        names = np.full(n, -1, np.int32)
        names[place] = name
        yield length, names, name, place
        place = np.sort(place)
        place = place[place + 2 * length <= end[place]]
        place = place[names[place + length] >= 0]
        name = names[place].astype(np.int64) * (int(number[-1]) + 1) + names[place + length]
        length *= 2


def _proposals(length: int, name: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) where successor occurrences begin an arithmetic progression."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(place) < 3:
        return none
    gap = place[1:] - place[:-1]
    least = 0 if length == 1 else length
    steady = (name[2:] == name[:-2]) & (gap[1:] == gap[:-1]) & (gap[:-1] > least) & (gap[:-1] <= 2 * length)
    at = np.flatnonzero(steady)
    if not len(at):
        return none
    # Of places side by side with one distance, the first stands for all.
    place, gap = place[at], gap[at]
    order = np.lexsort((place, gap))
    place, gap = place[order], gap[order]
    head = np.append(True, (gap[1:] != gap[:-1]) | (place[1:] != place[:-1] + 1))
    return place[head], gap[head]


def _reach(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """For how many words the texts agree from ``a`` and ``b`` on, or before them."""
    a, b, done = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    last = len(levels) - 1
    for k in range(last, -1, -1):
        names, step = levels[k], 1 << k
        active = np.arange(len(a))
        while len(active):
            x, y = (a[active] - step, b[active] - step) if back else (a[active], b[active])
            inside = (x >= 0) & (y < len(names))
            left, right = names[np.maximum(x, 0)], names[np.minimum(y, len(names) - 1)]
            active = active[inside & (left >= 0) & (left == right)]
            move = -step if back else step
            a[active] += move
            b[active] += move
            done[active] += step
            if k < last:  # twice at a lower level is once at the level above
                break
    return done


def find_runs(
    codes: np.ndarray, counts: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs in texts of ``counts`` words each, by text, start and period."""
    if min_periods < 4:
        raise ValueError("runs of fewer than four periods may have no progression")
    levels, found = [], []
    for length, names, name, place in basic_factors(codes.astype(np.int64), counts):
        levels.append(names)
        found.append(_proposals(length, name, place))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    place, period = (np.concatenate(x) for x in zip(*found, strict=True))
    start = place - _reach(levels, place, place + period, back=True)
    stop = place + period + _reach(levels, place, place + period, back=False)
    enough = stop - start >= np.maximum(min_length, min_periods * period)
    start, stop, period = start[enough], stop[enough], period[enough]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    # A stretch also repeats at multiples of its smallest period.
    first = np.append(True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1]))[: len(start)]
    start, stop, period = start[first], stop[first], period[first]
    order = np.lexsort((period, start))
    start, stop, period = start[order], stop[order], period[order]
    ends = np.cumsum(counts)
    text = np.searchsorted(ends, start, "right")
    return text, start - (ends - counts)[text], stop - start, period


def kept_words(counts: np.ndarray, text, start, length, period) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    begins = np.cumsum(counts) - counts
    change = np.zeros(int(counts.sum()) + 1, np.int64)
    np.add.at(change, begins[text] + start + period, 1)
    np.add.at(change, begins[text] + start + length, -1)
    return np.cumsum(change[:-1]) == 0


def _joined(distinct: pa.Array, codes: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Words of each text, joined by a space; together they are no longer than the slice they come from."""
    offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, distinct.take(pa.array(codes))), " ")


def _collapse(min_length: int, min_periods: int):
    def collapsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text"), SLICE):
                codes, distinct, counts = split_words(texts)
                text, *run = find_runs(codes, counts, min_length, min_periods)
                stays = kept_words(counts, text, *run)
                owner = np.repeat(np.arange(len(texts)), counts)
                left = np.bincount(owner[stays], minlength=len(texts))
                several = np.bincount(text, minlength=len(texts))
                offsets = pa.array(np.append(0, np.cumsum(several)).astype(np.int32))
                structs = pa.StructArray.from_arrays([pa.array(x) for x in run], ["start", "length", "period"])
                bodies = _joined(distinct, codes[stays], left)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(texts)),
                        pa.array(counts),
                        pa.ListArray.from_arrays(offsets, structs),
                        bodies,
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
        release_memory()

    return collapsed


def collapse_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_periods: int = MIN_PERIODS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_words, runs and collapsed of each row.

    A run is a stretch of words with a smallest period, of at least ``min_length``
    words and ``min_periods`` periods, that can't be extended.  ``runs`` has them by
    start, then period, words numbered from 0.  ``collapsed`` joins by spaces the
    words that no run holds after its first period.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(
        _collapse(min_length, min_periods), FOUND.format(source.schema["doc_id"].dataType.simpleString())
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, with a run planted in the texts of about a tenth of the ids.

    With h the CRC-32 of the decimal id and g a tenth of it, texts with h % 10 = 0
    repeat, from word g % n on, their next 1 + (n - a) / (3 + g % 8) words.
    """
    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    some = docs.select("doc_id", "text", check.alias("__tl_check"))
    found = words(F.coalesce("text", F.lit("")))
    chosen = some.withColumn("__tl_words", F.when(F.col("__tl_check") % 10 == 0, found))
    n, g = F.size("__tl_words").cast("long"), F.floor(F.col("__tl_check") / 10)
    first = g % F.greatest(n, F.lit(1))
    period = 1 + F.floor((n - first) / (3 + g % 8))
    places = chosen.withColumns({"__tl_first": first, "__tl_period": period, "__tl_last": n - 1})
    repeated = F.array_join(
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("__tl_last")),
            lambda i: F.get(
                F.col("__tl_words"),
                F.when(i < F.col("__tl_first"), i)
                .otherwise(F.col("__tl_first") + (i - F.col("__tl_first")) % F.col("__tl_period"))
                .cast("int"),
            ),
        ),
        " ",
    )
    return places.select("doc_id", F.when(F.size("__tl_words") > 0, repeated).otherwise(F.col("text")).alias("text"))


def exponent_first(runs: Column) -> Column:
    """The run of the greatest length / period; of equal ones the first.  Null without runs."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.reduce(
        runs,
        none,
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )
