"""Repeated passages against brute force over all windows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import WORDS, sha
from tidelake.llm import super_kmers
from tidelake.llm.queries import REGISTRY


def brute(rows, window=50):
    """(doc_id, words, removed, what is left) of each row."""
    found = [(doc_id, WORDS.findall(text or "")) for doc_id, text in rows]
    least = {}
    for doc_id, w in found:
        for i in range(len(w) - window + 1):
            if doc_id is not None:
                key = tuple(w[i : i + window])
                least[key] = min(doc_id, least.get(key, doc_id))
    out = []
    for doc_id, w in found:
        gone = set()
        for i in range(len(w) - window + 1):
            if doc_id is not None and least[tuple(w[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def check(rows, out):
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    return got


def corpus(chance, n):
    """Texts that share passages, whole or with a word changed, in front, behind or twice; few different words."""
    word = lambda: "".join(chance.choices("abcd", k=2))
    shared = [[word() for _ in range(size)] for size in (49, 50, 51, 60, 130, 400)]
    rows = []
    for i in range(n):
        parts = [[word() for _ in range(chance.randrange(90))]]
        for _ in range(chance.randrange(4)):
            passage = list(chance.choice(shared))
            if chance.random() < 0.4:
                passage[chance.randrange(len(passage))] = "zz"
            parts += [passage, [word() for _ in range(chance.randrange(30))]]
        rows.append((i, chance.choice([" ", "\n", "\t "]).join(w for p in parts for w in p)))
    return rows


@pytest.mark.parametrize("most", [8192, 3])
def test_passages_are_those_of_brute_force(docs, monkeypatch, most):
    """Also with all buckets of over three super-k-mers counted by their windows' prints."""
    monkeypatch.setattr(super_kmers, "MOST", most)
    chance = random.Random(21)
    rows = corpus(chance, 120)
    rows += [(200 + k, rows[k][1]) for k in range(0, 40, 3)] + [(300, "x " * 400), (301, "x " * 90), (302, "x y " * 100)]
    got = check(rows, super_kmers.remove_passages(docs(rows)))
    assert sum(n > 0 for _, _, n, _ in got) > 40


def test_one_passage_in_most_documents(docs, large_tables, monkeypatch):
    """A hot passage with different words around it, over the limit of a task, with joins that shuffle."""
    monkeypatch.setattr(super_kmers, "MOST", 50)
    chance = random.Random(22)
    passage = " ".join("".join(chance.choices("abcdefgh", k=4)) for _ in range(70))
    rows = [(i, f"{i} own{i} words here {passage} and {i * i} more behind it") for i in range(300)]
    got = check(rows, super_kmers.remove_passages(docs(rows)))
    # The passage, "words here" before it and "and" behind it.
    assert sum(n == 73 for _, _, n, _ in got) == 299


def test_ids_that_are_null_or_repeated(docs):
    chance = random.Random(23)
    a, b, c = (" ".join("".join(chance.choices("abcdefgh", k=3)) for _ in range(80)) for _ in "abc")
    rows = [(1, a), (1, b), (1, a), (2, f"q {b}"), (2, f"{a} {c}"), (None, c), (None, a), (3, c), (0, None), (4, ""), (5, b)]
    check(rows, super_kmers.remove_passages(docs(rows)))


def test_edges(clashing, nothing):
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    check(rows, super_kmers.remove_passages(clashing))
    assert super_kmers.remove_passages(nothing).collect() == []


def test_long_texts_in_pieces(docs, monkeypatch):
    """Windows over the cut of two pieces are in one of them, and have the same minimiser there."""
    chance = random.Random(24)
    long = ["".join(chance.choices("abcdef", k=3)) for _ in range(900)]
    hashed = np.random.default_rng(1).integers(0, 1 << 63, len(long)).astype(np.uint64)
    whole = super_kmers.super_kmers(hashed, np.zeros(1, np.int64), np.array([len(long)]))
    of_window = {i: k for k, a, b in zip(*(x.tolist() for x in whole), strict=True) for i in range(a, b + 1)}
    assert sorted(of_window) == list(range(len(long) - 49))
    monkeypatch.setattr(super_kmers, "PIECE", 64)
    packed = super_kmers.Packed(pa.array([" ".join(long)]))
    cut = {}
    for base, begins, ends in packed.pieces():
        for k, a, b in zip(*(x.tolist() for x in super_kmers.super_kmers(hashed[base : base + int(ends[-1])], begins, ends)), strict=True):
            for i in range(a, b + 1):
                assert base + i not in cut
                cut[base + i] = k
    assert cut == of_window


def test_equal_hashes_of_different_windows():
    """The words decide, not the hash."""
    codes = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3], np.int32)
    start = np.array([0, 3, 6])
    order, first = super_kmers.equal_windows(codes, start, np.zeros(3, np.uint64), 3)
    classes = [sorted(order[a:b].tolist()) for a, b in zip(first, [*first[1:], 3], strict=True)]
    assert sorted(classes) == [[0, 2], [1]]


def test_query(spark, docs, tmp_path):
    rows = corpus(random.Random(25), 60) + [(90, None), (91, "")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = REGISTRY["op12_super_kmers"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted((d, n, m, sha(kept)) for d, n, m, kept in brute(rows))
