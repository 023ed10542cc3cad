"""Token counts by a finite-state transducer compiled from a byte-pair vocabulary.

The encoding of a string plus one character depends only on how the last few of
its prefixes end: the last token of a prefix is the longest piece that ends there
and may follow the last token of what is before it ("may follow" means that the
two, written together, are encoded as the two).  So the last tokens at the last
16 places are a state, a character is a transition, and the transition carries
the number of tokens it adds.  States are made when first met and kept.

White space, line ends and every other pair of neighbours that no piece holds
reset the state, as no piece reaches over them: a unit between resets maps every state to the same one, with its count.  Maps of units
compose by adding counts, so a slice of texts is counted with one prefix sum.  A
long unit without a reset is walked state by state.

Defined results: a null or empty text has no tokens; strings of special tokens
are ordinary text, as is the library's default.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .word_codes import slices

SPACE = "▁"
#: Units, and states with their transitions, remembered; beyond it they are made anew.
REMEMBERED = 800_000
REMEMBERED_STATES = 400_000


class Transducer:
    """Counts tokens as a BPE model with byte fallback does."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))
        }
        order = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        #: Pieces with a smaller rank are merged first.
        self.rank = {piece: order[score] for piece, score in scores.items()}
        self.parts: dict[str, list[str] | None] = {}
        self.longest = max(map(len, self.rank))
        #: The length of the longest piece with these two last characters.
        self.reach: dict[str, int] = {}
        for piece in self.rank:
            self.reach[piece[-2:]] = max(len(piece), self.reach.get(piece[-2:], 1))
        self.neighbours = {piece[i : i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        across = [p for p in self.rank if SPACE in p.lstrip(SPACE) or "\n" in p]
        if across:
            raise ValueError(f"pieces reach over white space: {across[:3]}")
        self.follows: dict[tuple[str, str], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.units: dict[str, int] = {}
        self.forget_states()

    def forget_states(self) -> None:
        """States by number: the last characters, the last token at each, and the tokens up to each.

        The tokens are counted from the start while it is in reach, and else from a
        number that makes equal states equal.
        """
        self.next: dict[tuple[int, str], tuple[int, int]] = {}
        self.states: list[tuple[str, tuple[str, ...], tuple[int, ...]]] = []
        self.numbers: dict[tuple, int] = {}
        self.number(("", (), ()))

    def number(self, state: tuple[str, tuple[str, ...], tuple[int, ...]]) -> int:
        text, lasts, totals = state
        if len(text) >= self.longest:
            totals = tuple([t - totals[-1] for t in totals])
            state = text, lasts, totals
            found = self.numbers.get(state)
            if found is not None:
                return found
            self.numbers[state] = len(self.states)
        self.states.append(state)
        return len(self.states) - 1

    def merged(self, text: str, least: int = 1) -> list[str]:
        """The pieces of a short text, by merging the best pair again and again."""
        parts = list(text)
        while len(parts) > least:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, piece: str) -> list[str] | None:
        """The two parts that a piece is merged from; None for a character."""
        if piece not in self.parts:
            self.parts[piece] = self.merged(piece, 2) if len(piece) > 1 else None
        return self.parts[piece]

    def may_follow(self, left: str, right: str) -> bool:
        """Whether the two, written together, are encoded as the two.

        Their last merges are undone, the later one first.  If the parts at the
        boundary could have been merged before that, they would have been; among
        equal ranks the leftmost merge comes first.
        """
        key = left, right
        known = self.follows.get(key)
        if known is not None:
            return known
        if len(self.follows) > REMEMBERED_STATES:
            self.follows.clear()
        limit = len(self.rank)
        while True:
            if self.rank.get(left + right, limit) < limit:
                known = False
                break
            a, b = self.halves(left), self.halves(right)
            if a and (not b or self.rank[left] > self.rank[right]):
                limit, left = self.rank[left], a[1]
            elif b:
                limit, right = self.rank[right] + 1, b[0]
            else:
                known = True
                break
        self.follows[key] = known
        return known

    def step(self, state: int, char: str) -> tuple[int, int]:
        """(next state, tokens added)."""
        text, lasts, totals = self.states[state]
        text += char
        here = len(lasts)
        rank, follows = self.rank, self.follows
        for length in range(min(self.reach.get(text[-2:], 1), here + 1), 0, -1):
            piece = text[-length:]
            if length > 1 and piece not in rank:
                continue
            before = here - length
            if before < 0:
                break
            known = follows.get((lasts[before], piece))
            if known or known is None and self.may_follow(lasts[before], piece):
                break
        else:
            raise AssertionError("a single character may always follow")
        # A character that is no piece is spelt in bytes.
        total = (1 if piece in rank else len(piece.encode())) + (totals[before] if before >= 0 else 0)
        added = total - (totals[-1] if here else 0)
        keep = self.longest
        if here == keep:
            text, lasts, totals = text[1:], lasts[1:], totals[1:]
        return self.number((text, (*lasts, piece), (*totals, total))), added

    def count(self, text: str) -> int:
        """Tokens of a text without a reset; transitions met before are looked up."""
        state, total = 0, 0
        for char in text:
            found = self.next.get((state, char))
            if found is None:
                if len(self.states) > REMEMBERED_STATES:
                    now = self.states[state]
                    self.forget_states()
                    state = self.number(now)
                found = self.next[state, char] = self.step(state, char)
            state, added = found
            total += added
        return total

    def unit(self, unit: str) -> int:
        """Tokens of a unit.  The state is reset too between two characters that are neighbours in no piece."""
        known = self.units.get(unit)
        if known is None:
            cuts = [i for i in range(1, len(unit)) if unit[i - 1 : i + 1] not in self.neighbours]
            if cuts:
                known = sum(map(self.unit, map(unit.__getitem__, map(slice, [0, *cuts], [*cuts, len(unit)]))))
            else:
                known = self.count(unit)
            self.units[unit] = known
        return known

    def text(self, text: str) -> int:
        """Tokens of a whole text, whatever spaces it has."""
        return sum(map(self.unit, re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE)))) if text else 0

    def count_texts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of a slice."""
        if len(self.units) > REMEMBERED:
            self.units.clear()
        parts = pc.split_pattern(texts, " ")
        coded = pc.list_flatten(parts).dictionary_encode()
        places = coded.indices.to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary.to_pylist()
        # A part stands for the space before it; empty parts would share one unit with the next.
        odd = np.array([not w or SPACE in w for w in words])
        counts = np.array([0 if o else self.unit(SPACE + w) for w, o in zip(words, odd, strict=True)], np.int64)
        ends = np.cumsum(sizes)
        sums = np.concatenate([[0], np.cumsum(counts[places])])
        odds = np.concatenate([[0], np.cumsum(odd[places])])
        out = sums[ends] - sums[ends - sizes]
        for i in np.flatnonzero(odds[ends] > odds[ends - sizes]).tolist():
            out[i] = self.text(texts[i].as_py())
        return out


@lru_cache(maxsize=1)
def transducer(path: str) -> Transducer:
    """One for each worker process, kept between its tasks."""
    return Transducer(path)


def count_tokens(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of each row of ``docs``, by the vocabulary of ``model``."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                columns = [batch.column("doc_id").slice(at, len(texts)), pc.binary_length(texts).cast(pa.int64())]
                columns.append(pa.array(machine.count_texts(texts)))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
