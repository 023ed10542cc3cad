"""Token ids as directly addressable codes.

An id is cut into chunks of eight bits.  Level 0 holds the lowest chunk of every
id; a bitmap beside it says whose id goes on, and level 1 holds the next chunk of
those, and so on.  A rank directory holds the set bits before each 512-bit block
of a bitmap, so the place of any token's next chunk is a directory entry plus the
bits of one block: any token is read without decoding others.

A file is a run of segments (rows of a Parquet table, whose columns are the
binary parts).  Segments hold whole documents in ascending order of their id.
``write`` sorts by range, so files follow each other too, and the ids before a
file come from the files' totals.

Defined results: a null or empty text is the end id alone; null ids come first;
rows of one id are ordered by text; an empty table gives an empty file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .word_codes import encoded

CHUNK_BITS = 8
BLOCK = 512
SEGMENT = (
    "file int, segment int, n_tokens long, doc_ids array<bigint>, n_doc_tokens array<bigint>, "
    "chunks array<binary>, bitmaps array<binary>, ranks array<binary>"
)
SEGMENT_ARROW = pa.schema(
    [
        ("file", pa.int32()),
        ("segment", pa.int32()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_doc_tokens", pa.list_(pa.int64())),
        ("chunks", pa.list_(pa.binary())),
        ("bitmaps", pa.list_(pa.binary())),
        ("ranks", pa.list_(pa.binary())),
    ]
)


def encode_ids(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """(chunks, continuation bitmaps, rank directories) by level; the last level goes on nowhere."""
    chunks, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        chunks.append((rest & 0xFF).astype(np.uint8).tobytes())
        more = rest >= 1 << CHUNK_BITS
        if not more.any():
            return chunks, bitmaps, ranks
        bits = np.packbits(more, bitorder="little")
        bitmaps.append(bits.tobytes())
        ones = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(more), BLOCK))
        ranks.append((np.cumsum(ones) - ones).astype("<u4").tobytes())
        rest = rest[more] >> CHUNK_BITS


def decode_ids(chunks: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a segment, as unsigned 32-bit integers."""
    value = np.zeros(0, np.uint32)
    for level in range(len(chunks) - 1, -1, -1):
        low = np.frombuffer(chunks[level], np.uint8).astype(np.uint32)
        if level < len(bitmaps):
            more = np.unpackbits(np.frombuffer(bitmaps[level], np.uint8), count=len(low), bitorder="little")
            low[more.astype(bool)] |= value << np.uint32(CHUNK_BITS)
        value = low
    return value


def token_at(chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes], place: int) -> int:
    """One token of a segment, by a rank for each of its chunks."""
    value = 0
    for level, chunk in enumerate(chunks):
        value |= chunk[place] << (CHUNK_BITS * level)
        if level == len(bitmaps) or not bitmaps[level][place >> 3] >> (place & 7) & 1:
            return value
        block = place // BLOCK
        before = int.from_bytes(bitmaps[level][block * BLOCK // 8 : place // 8 + 1], "little")
        inside = (before & ((1 << (place - block * BLOCK)) - 1)).bit_count()
        place = int.from_bytes(ranks[level][4 * block : 4 * block + 4], "little") + inside
    raise AssertionError("a bitmap points past the last level")


def _segments(path: str, end_id: int):
    def write_some(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        for number, (batch, ids, counts) in enumerate(encoded(batches, path, end_id)):
            row = [file, number, len(ids), batch.column("doc_id").to_pylist(), counts.tolist(), *encode_ids(ids)]
            yield pa.RecordBatch.from_pylist([dict(zip(SEGMENT_ARROW.names, row, strict=True))], SEGMENT_ARROW)

    return write_some


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, files: int | None = None) -> None:
    """Tokenize ``docs`` (doc_id, text) and write all ids, documents ascending by doc_id."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows of one id, or without one, however many, spread over files by their texts.
    order = ("doc_id", F.substring("text", 1, 32), F.xxhash64("text"))
    ranged = source.repartitionByRange(*([files] if files else []), *order)
    in_order = ranged.sortWithinPartitions(*order)
    in_order.mapInArrow(_segments(tokenizer, end_id), SEGMENT).write.parquet(folder)


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            view = memoryview(decode_ids(row["chunks"], row["bitmaps"]).astype("<u4")).cast("B")
            counts = np.array(row["n_doc_tokens"], np.int64)
            ends = np.cumsum(counts)
            crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(counts), row["file"], np.int32)),
                    pa.array(np.full(len(counts), row["segment"], np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(ends - counts),
                    pa.array(counts),
                    pa.array(crcs, pa.int64()),
                ],
                names=["file", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )


def segment_starts(segments: DataFrame) -> DataFrame:
    """(file, segment, before): the ids in front of each segment.

    One row per file meets in a running sum; that within a file is a window of it.
    """
    totals = segments.groupBy("file").agg(F.sum("n_tokens").alias("_all"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("_all").over(ahead), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    places = segments.select("file", "segment", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("_in"))
    return places.join(bases, "file").select("file", "segment", (F.col("_base") + F.col("_in")).alias("before"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of each document, from the files."""
    segments = spark.read.schema(SEGMENT).parquet(folder)
    found = segments.mapInArrow(
        _documents, "file int, segment int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    return found.join(segment_starts(segments), ["file", "segment"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


#: Positions and segments meet by stretches of so many ids.
STRETCH = 1 << 20


def _tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(len(batch)):
            row = batch.slice(at, 1).to_pylist()[0]
            places = [(p, token_at(row["chunks"], row["bitmaps"], row["ranks"], p - row["before"])) for p in row["places"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in places], pa.int64()), pa.array([t for _, t in places], pa.int64())],
                names=["position", "token"],
            )


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame, position: str = "position") -> DataFrame:
    """(position, token): the ids at the given places of the whole corpus, counted from 0.

    A position meets its segment by the segments' starts, and only segments that hold
    one are read; in a segment the rank directories lead to each id, and nothing else
    is decoded.  A position asked for twice is one row; places outside have none.
    """
    segments = spark.read.schema(SEGMENT).parquet(folder)
    spans = segments.select("file", "segment", "n_tokens").join(segment_starts(segments), ["file", "segment"])
    spans = spans.where("n_tokens > 0").withColumn(
        "stretch",
        F.explode(F.sequence(F.floor(F.col("before") / STRETCH), F.floor((F.col("before") + F.col("n_tokens") - 1) / STRETCH))),
    )
    asked = positions.select(F.col(position).cast("long").alias("place")).where("place >= 0").distinct()
    asked = asked.withColumn("_stretch", F.floor(F.col("place") / STRETCH))
    inside = (F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("n_tokens"))
    found = (
        asked.join(spans, (F.col("_stretch") == F.col("stretch")) & inside)
        .groupBy(F.col("file").alias("_file"), F.col("segment").alias("_segment"))
        # No more of a segment than it has ids.
        .agg(F.collect_list("place").alias("places"), F.first("before").alias("before"))
    )
    same = (F.col("file") == F.col("_file")) & (F.col("segment") == F.col("_segment"))
    wanted = segments.join(found, same).select("chunks", "bitmaps", "ranks", "places", "before")
    return wanted.mapInArrow(_tokens, "position long, token long")
