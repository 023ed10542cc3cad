"""Token ids of Arrow text columns, word by word.

The vocabulary drops white space, and no token reaches over it, so the ids of a
text are those of its space-separated words in order.  Arrow splits a slice of
texts and numbers its distinct words; the library is asked only for words not
met lately, and numpy lays out the ids.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once (at least one text), and words remembered.
SLICE_BYTES = 8 << 20
#: For ids; in larger slices more words are met again.
ENCODED_BYTES = 12 << 20
REMEMBERED = 1_000_000
#: Bytes of remembered words and ids, and the longest word remembered past its slice.
REMEMBERED_BYTES = 96 << 20
LONGEST = 256
#: Texts that show whether a vocabulary's ids go word by word, without regard to case.
PROBES = ("Ab ab", "the Cat\nsat", "x1, y. Z", "don't stop", "\u00e9t\u00e9 ici", "a\u4e2d b", "--- ##")
#: Such words, and all of ASCII, keep their ids when written beside others in one text, if they
#: don't have the "<" of the special tokens.
PLAIN = re.compile(r"[!-~À-ɏ]+")
ENCODED_AT_ONCE = 4096


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts): runs of rows of about ``most`` bytes; null is empty."""
    texts = pc.fill_null(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield at, texts.slice(at, stop - at)
        at = stop


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(word numbers, distinct words, number of words of each text); words are never empty."""
    parts = pc.ascii_split_whitespace(texts)
    owner = pc.list_parent_indices(parts)
    flat = pc.list_flatten(parts)
    some = pc.not_equal(flat, "")
    owner = pc.filter(owner, some).to_numpy(zero_copy_only=False)
    coded = pc.filter(flat, some).dictionary_encode()
    return (
        coded.indices.to_numpy(zero_copy_only=False),
        coded.dictionary,
        np.bincount(owner, minlength=len(texts)).astype(np.int64),
    )


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + lengths[i] - 1 for each i, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    small = total + (int(starts.max()) if len(starts) else 0) < 1 << 31
    kind = np.int32 if small else np.int64
    places = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    places += np.arange(total, dtype=kind)
    return places


def digests(raw: bytes | np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits of each part of ``raw``, as two numbers."""
    view = memoryview(raw)
    parts = [hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
    return np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)


class Ragged:
    """Growing runs of ids, each with a place."""

    def __init__(self) -> None:
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.starts, self.lengths, self.n = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64), 0

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        """The place of the first of the new runs."""
        self.flat = self._room(self.flat, self.used + len(ids))
        self.starts, self.lengths = (self._room(x, self.n + len(lengths)) for x in (self.starts, self.lengths))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[self.n : self.n + len(lengths)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.n : self.n + len(lengths)] = lengths
        self.used += len(ids)
        self.n += len(lengths)
        return self.n - len(lengths)

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        return np.concatenate([array, np.empty(max(size - len(array), len(array)), array.dtype)])

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the runs one after another, their lengths)."""
        lengths = self.lengths[places]
        return self.flat[ragged(self.starts[places], lengths)], lengths


class WordCodes:
    """Ids by word for one tokenizer file."""

    def __init__(self, path: str, remembered: int | None = None) -> None:
        self.remembered = REMEMBERED if remembered is None else remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._check(path)
        self.forget()

    def _check(self, path: str) -> None:
        """Refuse a vocabulary whose ids of a text are not those of its words in lower case."""
        for probe in PROBES:
            whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
            parts = [self.tokenizer.encode(w.lower(), add_special_tokens=False).ids for w in probe.split()]
            if whole != [i for part in parts for i in part]:
                raise ValueError(f"{path}: its tokens reach over spaces or depend on case; words can't be encoded by themselves")

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.runs = Ragged()
        self.bytes = 0

    def _alone(self, words: list[str]) -> None:
        for word in words:
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32)
            self.place[word] = self.runs.add(ids, np.array([len(ids)]))

    def _together(self, words: list[str]) -> None:
        """Plain words are encoded in one text; a token belongs to the word its first character is in."""
        for at in range(0, len(words), ENCODED_AT_ONCE):
            some = words[at : at + ENCODED_AT_ONCE]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            begins = np.cumsum([0, *(len(w) + 1 for w in some)])
            owner = np.searchsorted(begins, np.array([a for a, _ in found.offsets], np.int64), "right") - 1
            first = self.runs.add(np.array(found.ids, np.uint32), np.bincount(owner, minlength=len(some)))
            self.place.update(zip(some, range(first, first + len(some)), strict=True))

    def _learn(self, words: list[str]) -> None:
        """A plain word's ids are those of its lower case, then of a last stop."""
        odd, whole, stopped = [], [], []
        todo: dict[str, None] = {}
        place = self.place
        for word in words:
            if "<" in word or not (word.isascii() or PLAIN.fullmatch(word)):
                odd.append(word)
            elif word[-1] in ".," and word[-2:-1].isalpha() and word[-2:-1].isascii():
                core = word[:-1].lower() if word.isascii() else word[:-1]
                stopped.append((word, core))
                if core not in place:
                    todo[core] = None
            else:
                core = word.lower() if word.isascii() else word
                whole.append((word, core))
                if core not in place:
                    todo[core] = None
        self._alone(odd + [s for s in ".," if s not in place])
        self._together(list(todo))
        place.update([(word, place[core]) for word, core in whole])
        if stopped:
            cores = np.array([place[core] for _, core in stopped])
            stops = np.array([place[word[-1]] for word, _ in stopped])
            ids, lengths = self.runs.take(np.stack([cores, stops], axis=1).ravel())
            first = self.runs.add(ids, lengths.reshape(-1, 2).sum(axis=1))
            place.update(zip([word for word, _ in stopped], range(first, first + len(stopped)), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each text) of a slice."""
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            # The vocabulary has lower case only; a special token is not made by this.
            texts = pc.ascii_lower(texts)
        coded, distinct, n_words = split_words(texts)
        if not len(coded):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        if len(self.place) > self.remembered or self.bytes + 4 * self.runs.used > REMEMBERED_BYTES:
            self.forget()
        words = distinct.to_pylist()
        new = [w for w in words if w not in self.place]
        self._learn(new)
        places = np.fromiter(map(self.place.__getitem__, words), np.int32, len(words))
        ids, lengths = self.runs.take(places[coded])
        # A learned word may also stand there in lower case, or without its last stop.
        self.bytes += sum(len(w) + 100 for w in new)
        for word in new:
            if len(word) > LONGEST:
                for form in (word, word.lower(), word[:-1], word[:-1].lower()):
                    self.place.pop(form, None)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(n_words)
        return ids, sums[ends] - sums[ends - n_words]


@lru_cache(maxsize=1)
def word_codes(path: str, remembered: int = REMEMBERED) -> WordCodes:
    """One for each worker process, kept between its tasks."""
    return WordCodes(path, remembered)


def release_memory() -> None:
    """Give freed memory back, as a worker that waits for other stages' tasks would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only with this C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def encoded(
    batches: Iterable[pa.RecordBatch],
    path: str,
    end_id: int,
    slice_bytes: int = ENCODED_BYTES,
    remembered: int = REMEMBERED,
):
    """(batch slice, ids, number of ids of each row) with ``end_id`` after each text."""
    # What other stages' tasks left in this worker.
    release_memory()
    codes = word_codes(path, remembered)
    for batch in batches:
        for at, texts in slices(batch.column("text"), slice_bytes):
            ids, counts = codes.encode(texts)
            with_end = np.full(len(ids) + len(counts), end_id, np.uint32)
            ends = np.cumsum(counts + 1)
            body = np.ones(len(with_end), bool)
            body[ends - 1] = False
            with_end[body] = ids
            yield batch.slice(at, len(texts)), with_end, counts + 1
            del ids, with_end, body
    release_memory()
