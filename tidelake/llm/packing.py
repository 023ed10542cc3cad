"""Hierarchical residual packing of documents into sequences of a fixed size.

Each partition tokenizes its documents, cuts those longer than a sequence, and
packs what is left best-fit, longest first.  Nearly full bins are done.  The
others become items of a next round, in which the bins of eight partitions meet
in one task and are packed best-fit again, and so on up a tree.  Only a bin's
number and fill move up; a bin's parents are looked up at the end.

Memory: a partition packs 200,000 items at a time.  The bins that a task hands on
are in groups of 8,192, those with most room first, and bins of one group of eight
partitions meet in a task.  So every bin with room takes part in every round, and no
task's input grows with the data.

Defined results: a null or empty text is the end id alone; null or repeated ids
are packed row by row; an empty table gives no sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .word_codes import ENCODED_BYTES, REMEMBERED, encoded

SEQUENCE = 2048
LOCAL_ITEMS = 200_000
NEARLY_FULL = 0.998
FAN_IN = 8
#: The most bins that a task hands on to one task of the next round.
HANDED_ON = 8192
#: Bins are numbered within a partition; the partition is in the bits above.
PARTITION_BITS = 36


class BestFit:
    """Open bins by the room they have left; the fullest bin that can take an item gets it."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.rooms = [[] for _ in range(size + 1)]
        self.mask = 0
        self.fills: list[int] = []

    def put(self, length: int) -> tuple[int, int]:
        """(bin, place in it) of an item of ``length``."""
        fitting = self.mask >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = self.rooms[room].pop()
            if not self.rooms[room]:
                self.mask ^= 1 << room
        else:
            at, room = len(self.fills), self.size
            self.fills.append(0)
        offset = self.fills[at]
        self.fills[at] += length
        if room > length:
            self.rooms[room - length].append(at)
            self.mask |= 1 << (room - length)
        return at, offset


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each item, place in it, fill of each bin), longest items first."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    packer = BestFit(size)
    for i in np.argsort(-lengths, kind="stable").tolist():
        bins[i], offsets[i] = packer.put(int(lengths[i]))
    return bins, offsets, np.array(packer.fills, np.int64)


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("bin", pa.int64()),
        ("bin_offset", pa.int64()),
        ("bin_fill", pa.int64()),
    ]
)


def _pieces(
    batches: Iterable[pa.RecordBatch], path: str, end_id: int, size: int, memory: tuple[int, int]
) -> Iterator[dict[str, np.ndarray]]:
    for batch, ids, counts in encoded(batches, path, end_id, *memory):
        ids = ids.astype("<u4")
        firsts = np.cumsum(counts) - counts
        per_doc = -(-counts // size)
        row = np.repeat(np.arange(len(counts)), per_doc)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        start = piece * size
        length = np.minimum(size, counts[row] - start)
        view = memoryview(ids).cast("B")
        begins = ((firsts[row] + start) * 4).tolist()
        ends = ((firsts[row] + start + length) * 4).tolist()
        yield {
            "doc": batch.column("doc_id").take(pa.array(row)),
            "piece": piece,
            "start": start,
            "length": length,
            "crc": np.array([zlib.crc32(view[a:b]) for a, b in zip(begins, ends, strict=True)], np.int64),
        }


def _local(path: str, end_id: int, size: int, memory: tuple[int, int]):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << PARTITION_BITS

        def flush(held: list[dict]) -> pa.RecordBatch:
            nonlocal number
            lengths = np.concatenate([x["length"] for x in held])
            bins, offsets, fills = best_fit(lengths, size)
            columns = [
                pa.chunked_array([x["doc"] for x in held]).combine_chunks(),
                np.concatenate([x["piece"] for x in held]).astype(np.int32),
                np.concatenate([x["start"] for x in held]),
                lengths,
                np.concatenate([x["crc"] for x in held]),
                number + bins,
                offsets,
                fills[bins],
            ]
            number += len(fills)
            arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in columns]
            return pa.RecordBatch.from_arrays(arrays, schema=PIECES)

        held, n = [], 0
        for some in _pieces(batches, path, end_id, size, memory):
            held.append(some)
            n += len(some["length"])
            if n >= LOCAL_ITEMS:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    return pack


def _merge(size: int, handed_on: int):
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        bins, offsets, fills = best_fit(pdf["fill"].to_numpy(), size)
        # A merged bin goes by the smallest number in it.
        lead = pdf["bin"].groupby(bins).transform("min").to_numpy()
        # Eight groups came together, so no more than eight go on.
        place = np.empty(len(fills), np.int64)
        place[np.argsort(fills, kind="stable")] = np.arange(len(fills))
        group = pdf["group"] * FAN_IN + place[bins] // handed_on
        return pd.DataFrame(
            {"bin": pdf["bin"], "up": lead, "up_offset": offsets, "up_fill": fills[bins], "part": pdf["part"], "group": group}
        )

    return merge


def _with_room(bins: DataFrame, size: int) -> DataFrame:
    return bins.where(F.col("fill") < int(size * NEARLY_FULL))


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = SEQUENCE,
    end_id: int = 0,
    slice_bytes: int = ENCODED_BYTES,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece of a document: its ids' place in a sequence.

    ``slice_bytes`` of text at once and ``remembered`` words trade a worker's memory
    for time; they change no result.

    ``docs`` has doc_id and text.  The result has doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    local = source.mapInArrow(
        _local(tokenizer, end_id, size, (slice_bytes, remembered)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, bin_offset long, bin_fill long",
    )
    pieces = written(local, "packing-pieces")
    parts = source.rdd.getNumPartitions()
    out = pieces.select(
        *[c for c in pieces.columns if not c.startswith("bin")],
        F.col("bin").alias("sequence_id"),
        F.col("bin_offset").alias("offset"),
    )
    bins = pieces.where("bin_offset = 0").select(
        "bin", F.col("bin_fill").alias("fill"), F.shiftright("bin", PARTITION_BITS).alias("part")
    )
    # Of what one partition of the input holds.
    by_room = Window.partitionBy("part").orderBy("fill", "bin")
    number = F.row_number().over(by_room) - 1
    bins = _with_room(bins, size).withColumn("group", F.floor(number / HANDED_ON))
    while parts > 1:
        parts = -(-parts // FAN_IN)
        merged = written(
            bins.withColumn("part", F.floor(F.col("part") / FAN_IN))
            .groupBy("part", "group")
            .applyInPandas(
                _merge(size, HANDED_ON), "bin long, up long, up_offset long, up_fill long, part long, group long"
            ),
            "packing-round",
        )
        moved = merged.select(F.col("bin").alias("_bin"), "up", "up_offset")
        out = out.join(moved, F.col("sequence_id") == F.col("_bin"), "left").select(
            *[c for c in out.columns if c not in ("sequence_id", "offset")],
            F.coalesce("up", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("up_offset", F.lit(0))).alias("offset"),
        )
        bins = merged.where("up_offset = 0").select(
            F.col("up").alias("bin"), F.col("up_fill").alias("fill"), "part", "group"
        )
        bins = _with_room(bins, size)
    return out
