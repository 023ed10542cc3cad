"""Near duplicates, repeated bytes and top-k against brute force."""

import collections
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import LOWER, WORDS, sha
from tidelake.llm import ball_tree, hyper_minhash, suffix_dedup
from tidelake.llm.components import connected


def words(chance, n):
    return ["".join(chance.choices("abcdefghij", k=5)) for _ in range(n)]


def family(chance, n, copies, edits):
    """A text and copies of it with a few words changed."""
    base = words(chance, n)
    out = [" ".join(base)]
    for _ in range(copies):
        own = list(base)
        for _ in range(edits):
            own[chance.randrange(n)] = "".join(chance.choices("klmno", k=5))
        out.append(" ".join(own))
    return out


def shingles(text, size):
    found = WORDS.findall((text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def brute_components(rows, percent, size):
    sets = [(doc, shingles(text, size)) for doc, text in rows]
    label = {doc: doc for doc, _ in sets if doc is not None}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {doc: root(doc) for doc in label}, {doc: len(s) for doc, s in sets}


def check_components(rows, out, percent, size):
    component, sizes = brute_components(rows, percent, size)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles == sizes[r.doc_id]
        assert r.component_id == component.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


@pytest.mark.parametrize(("percent", "size"), [(85, 3), (80, 5)])
def test_near_duplicates(docs, percent, size):
    chance = random.Random(7)
    texts = []
    for n, edits in ((9, 1), (40, 1), (80, 2), (200, 4), (200, 9), (400, 8), (60, 12)):
        texts += family(chance, n, 6, edits)
    texts += ["a b", "A  B", "a", "", None, " \n", "same text here now", "Same text HERE now\n"]
    texts += ["a b c d e f", "a b c d e f g", "a b c d e f g h"]
    rows = list(enumerate(chance.sample(texts, len(texts))))
    check_components(rows, hyper_minhash.near_duplicates(docs(rows), percent, size), percent, size)


def test_large_groups_in_blocks(docs, monkeypatch):
    """Buckets of more than a block, with several components in them."""
    monkeypatch.setattr(hyper_minhash, "BLOCK", 8)
    chance = random.Random(8)
    rows = list(enumerate(family(chance, 60, 50, 3)))
    check_components(rows, hyper_minhash.near_duplicates(docs(rows)), 85, 3)


def test_near_duplicate_edges(clashing, nothing):
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    check_components(rows, hyper_minhash.near_duplicates(clashing), 85, 3)
    assert hyper_minhash.near_duplicates(nothing).collect() == []


def test_near_duplicates_of_one_id_with_two_texts(spark, docs):
    """Each text of a repeated id is linked by itself, and a copy without an id has no component."""
    chance = random.Random(17)
    (a, near_a), (b, near_b), (c, near_c) = (family(chance, 60, 1, 1) for _ in "abc")
    rows = [(5, a), (5, b), (7, near_a), (9, near_b), (None, a), (3, c), (7, near_c)]
    out = sorted(hyper_minhash.near_duplicates(docs(rows), 80, 5).collect(), key=lambda r: (r.doc_id or 0, r.component_id or 0))
    found = [(r.doc_id, r.component_id, r.kept) for r in out]
    assert found == [(None, None, True), (3, 3, True), (5, 5, True), (5, 5, True), (7, 3, False), (7, 5, False), (9, 5, False)]
    rows += [(9, " ".join(words(chance, 60)))]
    left = corpus_pipeline.near_dedup_stage(spark, docs(rows), "").collect()
    assert {(r.doc_id, r.text) for r in left} == {(5, a), (5, b), (None, a), (3, c), rows[-1]}


def test_estimates_follow_the_similarity():
    chance = np.random.default_rng(9)
    for shared in (0, 300, 800):
        common = chance.integers(0, 1 << 52, shared, dtype=np.uint64)
        a, b = (np.unique(np.append(common, chance.integers(0, 1 << 52, 1000 - shared, dtype=np.uint64))) for _ in "ab")
        wide = hyper_minhash.wide_sketches(np.concatenate([a, b]), np.array([len(a), len(b)]))
        assert abs(hyper_minhash.estimate(wide[0], wide[1]) - shared / (2000 - shared)) < 0.06


def test_connected(spark):
    chain = [(i, i + 1) for i in range(0, 30)] + [(100, 99), (101, 99), (5, 5)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {found[i] for i in range(31)} == {0} and {found[i] for i in (99, 100, 101)} == {99}


def brute_repeats(texts):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out.append((len(b), int(gone.sum()), int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if b else 0, sha(kept)))
    return out


@pytest.mark.parametrize("most", [16_384, 2])
def test_repeated_bytes(docs, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_PLACES", most)
    chance = random.Random(10)
    passage = " ".join(words(chance, 60))
    texts = [" ".join(words(chance, 80)) for _ in range(12)]
    texts += [" ".join([*words(chance, 20), passage[i : i + 199 + i], *words(chance, 20)]) for i in range(8)]
    texts += [passage, passage[:199], passage[:200], passage[1:], "x" * 1000, "ab" * 300, "ab" * 100]
    texts += [texts[0], texts[1][:150] + "é" + texts[1][150:], texts[2] + texts[2], None, "", "é🙂漢" * 70]
    rows = list(enumerate(texts))
    out = suffix_dedup.remove_repeats(docs(rows)).collect()
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), r.n_spans, sha(bytes(r.kept))) for r in out}
    for (doc, _), expected in zip(rows, brute_repeats(texts), strict=True):
        assert got[doc] == expected, doc


def test_repeated_bytes_edges(clashing, nothing, docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 4096)
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect() if r.doc_id != 4]
    chance = random.Random(11)
    long = " ".join(words(chance, 4000))
    rows += [(20, long), (20, long), (None, long[5000:9000]), (21, long[:700])]
    expected = collections.Counter(zip([d for d, _ in rows], brute_repeats([t for _, t in rows]), strict=True))
    out = suffix_dedup.remove_repeats(docs(rows)).collect()
    got = collections.Counter((r.doc_id, (r.n_bytes, r.n_bytes - len(r.kept), r.n_spans, sha(bytes(r.kept)))) for r in out)
    assert got == expected
    assert suffix_dedup.remove_repeats(clashing).count() == clashing.count()
    assert suffix_dedup.remove_repeats(nothing).collect() == []


@pytest.mark.parametrize("doc_id", [5, None])
def test_texts_of_one_id_are_told_apart(docs, doc_id):
    """Two texts of one id, equal in Spark's 32-bit hash; only the first one holds repeated bytes."""
    chance = random.Random(15)
    one, other = (" ".join(words(chance, 80)) for _ in range(2))
    rows = [(doc_id, f"{one} 10319"), (doc_id, f"{other} 389092"), (9, one)]
    assert docs(rows[:2]).select(F.hash("text")).distinct().count() == 1
    expected = collections.Counter(zip([d for d, _ in rows], brute_repeats([t for _, t in rows]), strict=True))
    out = suffix_dedup.remove_repeats(docs(rows)).collect()
    got = collections.Counter((r.doc_id, (r.n_bytes, r.n_bytes - len(r.kept), r.n_spans, sha(bytes(r.kept)))) for r in out)
    assert got == expected


def test_suffixes_sort_as_bytes_do():
    chance = np.random.default_rng(12)
    data = chance.integers(97, 99, 4000).astype(np.uint8)
    starts = chance.integers(0, 3700, 300)
    rooms = chance.integers(1, 200, 300)
    cuts = np.array([0, 1, 40, 41, 300])
    order, common = suffix_dedup._neighbours(data, starts, rooms, cuts, 1)
    text = [data[s : s + r].tobytes() for s, r in zip(starts, rooms, strict=True)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        assert [text[i] for i in order[a:b]] == sorted(text[a:b])
        assert common[a] == -1
        for k in range(a + 1, b):
            x, y = text[order[k - 1]], text[order[k]]
            same = next((n for n, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
            assert common[k] == same


def brute_top(rows, k):
    found = []
    for q, x in rows:
        if q % 20 == 0:
            scores = sorted((-int(np.dot(x, y)), v) for v, y in rows if v != q and len(x) == len(y))
            found += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scores[:k])]
    return sorted(found)


@pytest.mark.parametrize("shard", [8192, 40])
def test_top_k(spark, monkeypatch, shard):
    monkeypatch.setattr(ball_tree, "SHARD_ROWS", shard)
    monkeypatch.setattr(ball_tree, "BLOCK_ROWS", 7)
    monkeypatch.setattr(ball_tree, "LEAF_ROWS", 8)
    chance = np.random.default_rng(13)
    vectors = chance.normal(0, 0.3, (300, 6))
    vectors[50:90] = vectors[50]  # many equal ones, so ties
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ball_tree.top_k(df, df.where("vec_id % 20 = 0"), k=9).collect()
    exact = [(i, np.floor(64 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for i, v in rows]
    assert sorted(map(tuple, got)) == brute_top(exact, 9)


def test_large_components_are_exact(spark):
    """Products past doubles and past 64 bits, beside small ones; scores stop at the ends of 64 bits."""
    rows = [(0, [1e8, 2.0]), (20, [1.0, 1e9]), (3, [1e9, 1e9]), (4, [-1e9, 1e9 + 1]), (5, [0.5, 0.25]), (6, [1.0, 1e9 - 1]),
            (40, [1e30, -1e30]), (7, [1e30, 1e30]), (8, [1e30, 1e30 - 1e15]), (60, [1e300, 1.0]), (80, [0.1, -0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ball_tree.top_k(df, df.where("vec_id % 20 = 0"), k=9).collect()
    whole = [(i, [math.floor(64 * Fraction(x)) for x in v]) for i, v in rows]
    found = []
    for q, x in whole:
        if q % 20 == 0:
            clipped = lambda y: max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(x, y, strict=True))))  # noqa: B023, E731
            scores = sorted((-clipped(y), v) for v, y in whole if v != q)
            found += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scores[:9])]
    assert sorted(map(tuple, got)) == sorted(found)


def test_equal_rows_are_ranked_each(spark):
    rows = [(20, [1.0, 0.0])] + [(1, [2.0, 1.0])] * 500 + [(2, [1.0, 1.0]), (20, [3.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ball_tree.top_k(df, df.where("vec_id = 20"), k=4).collect()
    assert sorted(map(tuple, got)) == [(20, r, 1, 64 * 128) for r in range(1, 5)]


def test_top_k_edges(spark):
    bad = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 0.0]),
           (None, [1.0, 1.0]), (100, [1.0]), (120, []), (1, [3.0, -1.0]), (1, [3.0, -1.0])]
    df = spark.createDataFrame(bad, "vec_id long, embedding array<double>").withColumn("dim", F.lit("own"))
    got = ball_tree.top_k(df, df.where("vec_id % 20 = 0")).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 64 * 64), (0, 2, 1, 64 * 64)]
    assert ball_tree.top_k(df.limit(0), df.limit(0)).collect() == []
