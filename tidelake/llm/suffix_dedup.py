"""Removes byte strings of a given length that stand anywhere twice.

Sampling.  Every window of 200 bytes names an anchor, the place of its smallest
48-byte hash (the leftmost one of equal ones).  That depends on the window's bytes
only, so equal windows name the same place in themselves.  A run of windows with
one anchor is a block; about one byte in 75 is an anchor.  Only blocks whose
anchor's hash stands elsewhere too are looked at, with their bytes.

Suffix sort.  Equal blocks are counted by 128 bits before they travel, and one of
each kind is cut from its text.  Where all blocks of an anchor are equal, all of
their windows are repeated.  Otherwise a task sorts the kinds of a hash by what
follows the anchor and by what stands before it: a merge sort whose comparisons find
the common extension of two suffixes by binary search on prefix polynomial hashes.
The extensions of neighbours give, for each offset, which blocks agree on a whole
window.  All extensions of neighbours are checked byte by byte; a mismatch sorts
again with another base.

Skew.  Anchors are counted with partial aggregation, and kinds too.  Anchors of at
most 16,384 places go to a task by their hash.  For others the windows of the kinds
are counted by hash, also with partial aggregation.  What was found for a kind is
joined back to its places; the joins read written tables or shuffle both sides, so
adaptive execution may split a hot one.

Defined results: a null text is empty; a text shorter than a window loses
nothing; matches don't cross rows; rows of a repeated or null id are documents by
themselves; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake import folders

from .common import named_rows, null_safe, written, written_at
from .word_codes import digests, ragged, slices

WINDOW = 200
ANCHOR = 48
#: Anchors at more places are not sorted in one task.
MOST_PLACES = 16_384
SLICE = 1 << 20
INDEX_BITS = 21
U = np.uint64
KIND = ("key", "print_a", "print_b", "rows", "many")


class Hashes:
    """Prefix polynomial hashes of a byte buffer, modulo 2^64, with a random number for each byte."""

    def __init__(self, seed: int, room: int) -> None:
        rng = np.random.default_rng(seed)
        self.numbers = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
        self.base = int(rng.integers(1 << 62, 1 << 63)) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, U)
        self.grow(room)

    def grow(self, room: int) -> None:
        if room >= len(self.powers):
            size = 1 << (room + 1).bit_length()
            self.powers, self.inverses = (self._powers(x, size) for x in (self.base, self.inverse))

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.ones(size, U)
        done = 1
        while done < size:
            step = U(pow(base, done, 1 << 64))
            out[done : 2 * done] = out[: min(done, size - done)] * step
            done *= 2
        return out

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self.grow(len(data) + 1)
        out = np.zeros(len(data) + 1, U)
        np.cumsum(self.numbers[data] * self.powers[: len(data)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (prefix[start + length] - prefix[start]) * self.inverses[start]


_FIXED: list[Hashes] = []


def fixed_hashes() -> Hashes:
    """The hashes that all tasks choose anchors by."""
    if not _FIXED:
        _FIXED.append(Hashes(7, SLICE + 2 * WINDOW))
    return _FIXED[0]


def anchors(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window) of each block in the texts data[begins[i]:ends[i]]."""
    none = tuple(np.empty(0, np.int64) for _ in range(4))
    wide = WINDOW - ANCHOR + 1
    if len(data) < WINDOW:
        return none
    hashes = fixed_hashes()
    prefix = hashes.prefix(data)
    n = len(data) - ANCHOR + 1
    gram = (prefix[ANCHOR:] - prefix[:-ANCHOR]) * hashes.inverses[:n]
    gram = (gram ^ (gram >> U(29))) * U(0xBF58476D1CE4E5B9)
    gram ^= gram >> U(32)
    mask = U((1 << INDEX_BITS) - 1)
    value = np.full(-(-n // wide) * wide, U(0xFFFFFFFFFFFFFFFF))
    value[:n] = (gram & ~mask) | np.arange(n, dtype=U)
    rows = value.reshape(-1, wide)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(data) - WINDOW + 1
    chosen = (np.minimum(back[:starts], ahead[wide - 1 : wide - 1 + starts]) & mask).astype(np.int64)
    counts = np.maximum(0, ends - begins - WINDOW + 1)
    window = ragged(begins, counts)
    if not len(window):
        return none
    place = chosen[window]
    first = np.append(True, (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1))
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(window)) - 1
    return gram[place[at]].view(np.int64), place[at], window[at], window[last]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, begins, ends) for slices of a batch."""
    for at, texts in slices(batch.column("text"), SLICE):
        blob = texts.cast(pa.large_binary())
        lengths = pc.binary_length(blob).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(b"".join(blob.to_pylist()), np.uint8)
        yield at, len(texts), data, np.cumsum(lengths) - lengths, np.cumsum(lengths)


def _pieces(begin: int, end: int) -> list[tuple[int, int]]:
    """A long text in pieces, so that every window is in one of them."""
    return [(a, min(end, a + SLICE + WINDOW - 1)) for a in range(begin, max(begin + 1, end - WINDOW + 1), SLICE)]


def _find_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of each text.  A run holds its first window, and in a byte each, how far the anchor
    and the last window are behind it.
    """
    for batch in batches:
        for at, n, data, begins, ends in _texts(batch):
            parts = [(data, begins, ends, 0)]
            if len(data) > SLICE + WINDOW:
                # One long text, or a long one behind others: each by itself.
                parts = [
                    (data[a:b], np.zeros(1, np.int64), np.array([b - a]), a)
                    for x, y in zip(begins.tolist(), ends.tolist(), strict=True)
                    for a, b in _pieces(x, y)
                ]
            for some, x, y, base in parts:
                key, place, low, high = anchors(some, x, y)
                place, low, high = place + base, low + base, high + base
                row = np.searchsorted(ends, low, "right")
                own = begins[row]
                rows = pa.array(row + at)
                prints = digests(data, low, high + WINDOW)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key),
                        pa.array(prints[:, 0]),
                        pa.array(prints[:, 1]),
                        batch.column("name_a").take(rows),
                        batch.column("name_b").take(rows),
                        pa.array((low - own) << 16 | (place - low) << 8 | (high - low)),
                    ],
                    names=["key", "print_a", "print_b", "name_a", "name_b", "run"],
                )


def _cut_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each wanted kind of block, with its bytes."""
    for batch in batches:
        for at, n, data, begins, _ in _texts(batch):
            wanted = batch.column("kinds").slice(at, n)
            row = pc.list_parent_indices(wanted).to_numpy(zero_copy_only=False).astype(np.int64)
            hit = pc.list_flatten(wanted)
            run = pc.struct_field(hit, "run").to_numpy(zero_copy_only=False)
            low, lead, size = run >> 16, run >> 8 & 0xFF, (run & 0xFF) + WINDOW
            step = 20_000
            for x in range(0, len(row), step):
                s = slice(x, x + step)
                offsets = np.concatenate([[0], np.cumsum(size[s])]).astype(np.int32)
                raw = data[ragged(begins[row[s]] + low[s], size[s])]
                block = pa.BinaryArray.from_buffers(
                    pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pc.struct_field(hit, c).slice(x, step) for c in KIND),
                        pa.array(lead[s].astype(np.int32)),
                        block,
                    ],
                    names=[*KIND, "lead", "block"],
                )


def common_extension(hashes, prefix, a, b, most: np.ndarray) -> np.ndarray:
    """How far the suffixes at ``a`` and ``b`` agree, at most ``most``: binary search on hashes."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = hashes.of(prefix, a, middle) == hashes.of(prefix, b, middle)
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)
    return low


def _less(hashes, prefix, data, a, b, room_a, room_b) -> np.ndarray:
    """Whether suffix ``a`` sorts before suffix ``b``; equal ones don't."""
    most = np.minimum(room_a, room_b)
    common = common_extension(hashes, prefix, a, b, most)
    inside = common < most
    last = len(data) - 1
    by_byte = data[np.minimum(a + common, last)] < data[np.minimum(b + common, last)]
    return np.where(inside, by_byte, room_a < room_b)


def merge_sort(hashes, prefix, data, starts, rooms, cuts: np.ndarray) -> np.ndarray:
    """The suffixes' order, each group cuts[i]:cuts[i + 1] by itself.

    Runs of 1, 2, 4, ... are merged in all groups at once: a suffix goes behind
    those of its own run before it and those of the other run that are smaller,
    found by binary search.
    """
    order = np.arange(len(starts))
    sizes = np.diff(cuts)
    base = np.repeat(cuts[:-1], sizes)
    end = np.repeat(cuts[1:], sizes)
    width = 1
    while width < (sizes.max() if len(sizes) else 0):
        at = np.flatnonzero(end - base > width)
        own = at - base[at]
        run = own // width
        left = run % 2 == 0
        other = base[at] + np.where(left, run + 1, run - 1) * width
        stop = np.minimum(other + width, end[at])
        mine = order[at]
        low, high = np.minimum(other, stop), stop.copy()
        while True:
            open_ones = np.flatnonzero(low < high)
            if not len(open_ones):
                break
            middle = (low[open_ones] + high[open_ones]) // 2
            theirs, ours = order[middle], mine[open_ones]
            before = _less(hashes, prefix, data, starts[theirs], starts[ours], rooms[theirs], rooms[ours])
            # Equal suffixes of the left run stay in front.
            after = _less(hashes, prefix, data, starts[ours], starts[theirs], rooms[ours], rooms[theirs])
            goes = np.where(left[open_ones], before, ~after)
            low[open_ones] = np.where(goes, middle + 1, low[open_ones])
            high[open_ones] = np.where(goes, high[open_ones], middle)
        rank = low - np.minimum(other, stop)
        pair = base[at] + (run // 2) * 2 * width
        merged = order.copy()
        merged[pair + own % width + rank] = mine
        order = merged
        width *= 2
    return order


def _neighbours(data: np.ndarray, starts: np.ndarray, rooms: np.ndarray, cuts: np.ndarray, seed: int):
    """(order, how far each suffix agrees with the one before it in its group, -1 for a group's first)."""
    while True:
        hashes = Hashes(seed, len(data))
        prefix = hashes.prefix(data)
        order = merge_sort(hashes, prefix, data, starts, rooms, cuts)
        a, b = order[:-1], order[1:]
        most = np.minimum(rooms[a], rooms[b])
        common = common_extension(hashes, prefix, starts[a], starts[b], most)
        if _agree(data, starts[a], starts[b], common, most):
            common = np.append(-1, common)
            common[cuts[:-1]] = -1
            return order, common
        seed += 1


def _agree(data, a, b, common, most, step: int = 4096) -> bool:
    """Whether the pairs agree on just the common bytes, looked at one by one."""
    last = len(data) - 1
    for x in range(0, len(a), step):
        s = slice(x, x + step)
        far = np.arange(WINDOW)
        same = data[np.minimum(a[s, None] + far, last)] == data[np.minimum(b[s, None] + far, last)]
        inside = far < common[s, None]
        ends = common[s] < most[s]
        at_end = np.minimum(common[s], WINDOW - 1)
        if not same[inside].all() or same[np.flatnonzero(ends), at_end[ends]].any():
            return False
    return True


def repeated_offsets(
    key: np.ndarray, lead: np.ndarray, blocks: list[bytes], places: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """(row, first offset, last offset) of runs of windows that stand at two places of one key.

    Rows are sorted by key; each stands for one place, or as many as ``places`` says.
    An offset counts back from the anchor.
    """
    group = np.cumsum(np.append(0, key[1:] != key[:-1]))
    # Equal blocks are one, with its number of rows.
    seen: dict[tuple[int, int, bytes], int] = {}
    item = np.array([seen.setdefault(x, len(seen)) for x in zip(group.tolist(), lead.tolist(), blocks, strict=True)])
    n = len(seen)
    weight = np.bincount(item, minlength=n)
    held = weight if places is None else np.bincount(item, places, minlength=n)
    own_group = np.array([g for g, _, _ in seen], np.int64)
    own_lead = np.array([x for _, x, _ in seen], np.int64)
    raw = [b for _, _, b in seen]
    size = np.array([len(b) for b in raw], np.int64)
    after = size - own_lead
    nearest, farthest = np.maximum(0, WINDOW - after), own_lead
    found = [(i, int(nearest[i]), int(farthest[i])) for i in np.flatnonzero(held > 1).tolist()]
    several = np.flatnonzero(np.bincount(own_group)[own_group] > 1)
    if len(several):
        data = np.frombuffer(b"".join(raw[i] for i in several.tolist()), np.uint8)
        begins = np.cumsum(size[several]) - size[several]
        anchor = begins + own_lead[several]
        cuts = np.flatnonzero(np.append(True, np.diff(own_group[several]) != 0))
        cuts = np.append(cuts, len(several))
        right = _neighbours(data, anchor, np.minimum(after[several], WINDOW), cuts, 11)
        left = _neighbours(data[::-1].copy(), len(data) - anchor, own_lead[several], cuts, 13)
        near, far, many = nearest[several], farthest[several], held[several] > 1
        m = len(several)
        marks = np.zeros((WINDOW - ANCHOR + 3, m), bool)
        for offset in range(int(near.min()), int(far.max()) + 1):
            active = np.flatnonzero((near <= offset) & (offset <= far))
            classes = []
            for (order, common), depth in ((left, offset), (right, WINDOW - offset)):
                number = np.empty(m, np.int64)
                number[order] = np.cumsum(common < depth)
                classes.append(number[active])
            both = classes[0] * (m + 1) + classes[1]
            by = np.argsort(both, kind="stable")
            equal = both[by][1:] == both[by][:-1]
            twice = np.zeros(len(active), bool)
            twice[by[1:]] |= equal
            twice[by[:-1]] |= equal
            marks[offset + 1, active] = twice & ~many[active]
        change = marks[1:].astype(np.int8) - marks[:-1].astype(np.int8)
        which, first = np.nonzero(change.T == 1)
        _, stop = np.nonzero(change.T == -1)
        found += list(zip(several[which].tolist(), first.tolist(), (stop - 1).tolist(), strict=True))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    which, first, last = (np.array(x, np.int64) for x in zip(*found, strict=True))
    # From different blocks to the rows that hold them.
    by = np.argsort(item, kind="stable")
    begin = np.searchsorted(item[by], which)
    rows = by[ragged(begin, weight[which])]
    return rows, np.repeat(first, weight[which]), np.repeat(last, weight[which])


def _judge(pdfs: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Offsets of repeated windows of each kind, from rows sorted by key; a key's rows are whole before they are looked at."""

    def offsets(pdf: pd.DataFrame) -> pd.DataFrame:
        row, first, last = repeated_offsets(
            pdf["key"].to_numpy(np.int64),
            pdf["lead"].to_numpy(np.int64),
            pdf["block"].tolist(),
            pdf["rows"].to_numpy(np.int64),
        )
        return pdf[["key", "print_a", "print_b"]].iloc[row].assign(first=first, last=last)

    held = None
    for pdf in pdfs:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        key = pdf["key"].to_numpy(np.int64)
        last = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if last:
            yield offsets(pdf.iloc[:last])
        held = pdf.iloc[last:]
    if held is not None and len(held):
        yield offsets(held)


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of a kind by its hash, with its offset back from the anchor."""
    for batch in batches:
        for at in range(0, len(batch), 512):
            some = batch.slice(at, 512)
            raw = some.column("block").to_pylist()
            size = np.array([len(x) for x in raw], np.int64)
            begins = np.cumsum(size) - size
            counts = size - WINDOW + 1
            start = ragged(begins, counts).astype(np.int64)
            kind = np.repeat(np.arange(len(raw)), counts)
            prints = digests(b"".join(raw), start, start + WINDOW)
            lead = some.column("lead").to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(some.column(c).take(pa.array(kind)) for c in ("key", "print_a", "print_b", "rows")),
                    pa.array(lead[kind] - (start - begins[kind])),
                    pa.array(prints[:, 0]),
                    pa.array(prints[:, 1]),
                ],
                names=["key", "print_a", "print_b", "rows", "first", "window_a", "window_b"],
            )


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans."""
    for batch in batches:
        kept, n_bytes, n_spans = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            raw = (text or "").encode()
            parts, at, runs, end = [], 0, 0, -1
            for span in sorted((s["start"], s["stop"]) for s in spans or ()):
                if span[0] > end:
                    runs += 1
                    parts.append(raw[at : span[0]])
                end = max(end, span[1])
                at = end
            parts.append(raw[at:])
            kept.append(b"".join(parts))
            n_bytes.append(len(raw))
            n_spans.append(runs)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(kept, pa.binary()),
                pa.array(n_bytes, pa.int64()),
                pa.array(n_spans, pa.int64()),
            ],
            names=["doc_id", "kept", "n_bytes", "n_spans"],
        )


def _runs(offsets: Column) -> Column:
    """(first, last) of the runs of neighbours in a sorted array of different numbers."""
    first = F.filter(offsets, lambda x: ~F.array_contains(offsets, x - 1))
    last = F.filter(offsets, lambda x: ~F.array_contains(offsets, x + 1))
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, kept (bytes), n_bytes and n_spans of each row.

    Each step's table is written, so the shuffles before it can go.
    """
    spark = docs.sparkSession
    source = named_rows(docs, doc_id, text)
    name, kind = ("name_a", "name_b"), ("key", "print_a", "print_b")
    found, found_folder = written_at(
        source.mapInArrow(_find_anchors, "key long, print_a long, print_b long, name_a long, name_b long, run long"),
        "suffix-anchors",
    )
    often = written(
        found.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("places"),
            (F.min("print_a") != F.max("print_a")).alias("several"),
            (F.count(F.lit(1)) > MOST_PLACES).alias("many"),
        )
        .where("places > 1")
        .drop("places"),
        "suffix-often",
    )
    often, same = null_safe(often, "key")
    hits = written(found.join(often, same).drop("_key"), "suffix-hits")
    folders.remove(spark, found_folder)
    by_row = (
        hits.where("several")
        .groupBy(*kind)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.first("many").alias("many"),
            # Any place of a kind will do; the smallest name needs the fewest texts.
            F.min(F.struct("name_a", "name_b", "run")).alias("place"),
        )
        .groupBy(F.col("place.name_a").alias("name_a"), F.col("place.name_b").alias("name_b"))
        .agg(F.collect_list(F.struct(*KIND, "place.run")).alias("kinds"))
    )
    by_row, same = null_safe(by_row, *name)
    blocks = written(
        source.join(by_row, same)
        .select("text", "kinds")
        .mapInArrow(_cut_blocks, "key long, print_a long, print_b long, rows long, many boolean, lead int, block binary"),
        "suffix-blocks",
    )
    few = (
        blocks.where("NOT many")
        .drop("many")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInPandas(_judge, "key long, print_a long, print_b long, first long, last long")
    )
    windows = blocks.where("many").mapInArrow(
        _windows, "key long, print_a long, print_b long, rows long, first long, window_a long, window_b long"
    )
    twice = windows.groupBy("window_a", "window_b").agg(F.sum("rows").alias("all")).where("all > 1").drop("all")
    twice, same = null_safe(twice, "window_a", "window_b")
    spread = (
        windows.join(twice, same)
        .groupBy(*kind)
        .agg(F.sort_array(F.collect_set("first")).alias("offsets"))
        .select(*kind, F.explode(_runs(F.col("offsets"))).alias("run"))
        .select(*kind, "run.first", "run.last")
    )
    judged, same = null_safe(written(few.union(spread), "suffix-judged"), *kind)
    low, lead, size = F.shiftright("run", 16), F.shiftright("run", 8).bitwiseAND(F.lit(0xFF)), F.col("run").bitwiseAND(F.lit(0xFF))
    # At an anchor with equal blocks only, all of them are repeated.
    all_equal = hits.where("NOT several").select(*name, low.alias("start"), (low + size + WINDOW).alias("stop"))
    of_kind = (
        hits.where("several")
        .select(*kind, *name, "run")
        .join(judged, same)
        .select(*name, (low + lead - F.col("last")).alias("start"), (low + lead - F.col("first") + WINDOW).alias("stop"))
    )
    spans = all_equal.union(of_kind).groupBy(*name).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    spans, same = null_safe(spans, *name)
    return (
        source.join(spans, same, "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_remove, "doc_id long, kept binary, n_bytes long, n_spans long")
    )
