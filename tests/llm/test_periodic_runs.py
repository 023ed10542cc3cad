"""Periodic runs against brute force over all periods."""

import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import WORDS, sha
from tidelake.llm import periodic_runs
from tidelake.llm.queries import REGISTRY


def brute_runs(found, min_length=6, min_periods=4):
    out, seen = [], set()
    for q in range(1, len(found) // min_periods + 1):
        i = 0
        while i + q < len(found):
            start = i
            while i + q < len(found) and found[i] == found[i + q]:
                i += 1
            if i > start and i + q - start >= max(min_length, min_periods * q) and (start, i) not in seen:
                # Smaller periods of the same stretch came first.
                if not any(s == start and s + n == i + q for s, n, _ in out):
                    out.append((start, i + q - start, q))
                    seen.add((start, i))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(found, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(found) if i not in gone)


def planted(doc_id, found):
    n = len(found)
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return found
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [found[i] if i < a else found[a + (i - a) % p] for i in range(n)]


def texts_of(chance, n):
    out = []
    for _ in range(n):
        some = [chance.choice("abc"[: chance.randrange(1, 4)]) for _ in range(chance.randrange(70))]
        if some and chance.random() < 0.5:
            piece = some[: chance.randrange(1, 9)]
            at = chance.randrange(len(some))
            some[at:at] = piece * chance.randrange(2, 9)
        out.append(some)
    return out


@pytest.mark.parametrize(("min_length", "min_periods"), [(6, 4), (3, 5), (20, 4)])
def test_runs_are_those_of_brute_force(min_length, min_periods):
    chance = random.Random(11)
    for _ in range(150):
        texts = texts_of(chance, chance.randrange(1, 6))
        codes = np.array([ord(w) for t in texts for w in t], np.int32)
        got = periodic_runs.find_runs(codes, np.array([len(t) for t in texts]), min_length, min_periods)
        expected = [(i, *r) for i, t in enumerate(texts) for r in brute_runs(t, min_length, min_periods)]
        assert list(zip(*(x.tolist() for x in got), strict=True)) == expected


def test_words_of_periods_that_are_themselves_repetitive():
    """Fibonacci words and nested repeats: factors within a period occur many times."""
    a, b = ["x"], ["x", "y"]
    for _ in range(9):
        a, b = b, b + a
    for text in (b, a * 5, (["p"] * 7 + ["q"]) * 6, ((["p"] * 5 + ["q"]) * 4 + ["r"]) * 5):
        codes = np.array([ord(w) for w in text], np.int32)
        got = periodic_runs.find_runs(codes, np.array([len(text)]))
        assert list(zip(*(x.tolist() for x in got[1:]), strict=True)) == brute_runs(text)


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError, match="four"):
        periodic_runs.find_runs(np.zeros(9, np.int32), np.array([9]), 6, 3)


def test_edges(clashing, nothing):
    for r in periodic_runs.collapse_runs(clashing).collect():
        own = {x.doc_id: x.text for x in clashing.select("doc_id", "text").collect()}[r.doc_id]
        found = WORDS.findall(own or "")
        assert r.n_words == len(found)
        assert r.collapsed == brute_collapsed(found, [tuple(x) for x in r.runs])
    assert periodic_runs.collapse_runs(clashing).count() == clashing.count()
    assert periodic_runs.collapse_runs(nothing).collect() == []


def test_the_long_repeat_is_one_word(awkward):
    row = periodic_runs.collapse_runs(awkward).where("doc_id = 4").first()
    assert [tuple(x) for x in row.runs] == [(0, 60_000, 1)]
    assert row.collapsed == "word " + "x" * 300_000


def test_query(spark, docs, tmp_path):
    chance = random.Random(12)
    rows = [(i, "\n".join(" ".join(t[k : k + 9]) for k in range(0, len(t), 9))) for i, t in enumerate(texts_of(chance, 300))]
    rows += [(300, None), (301, ""), (302, " \t "), (None, "a b " * 9), (7, "z z z z z z z")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = REGISTRY["op11_periodic_runs"](spark, str(tmp_path)).collect()
    expected = []
    for doc_id, text in rows:
        found = planted(doc_id, WORDS.findall(text or ""))
        runs = brute_runs(found)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        milli = None if best[0] is None else math.floor(Fraction(1000 * best[1], best[2]))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected.append((doc_id, len(runs), *best, milli, sha(lines), sha(brute_collapsed(found, runs))))
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert sum(r.n_runs > 0 for r in got) > 50
