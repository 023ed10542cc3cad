"""Hard negatives against brute force, and what the trees skip."""

import math
import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidelake.llm import cover_tree
from tidelake.llm.exact_products import LEAST, MOST, products, whole_numbers
from tidelake.llm.queries import REGISTRY

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, step=50, positives=5, negatives=3, low=50, high=95, scale=256):
    fine = {
        (i, lab, tuple(v))
        for i, v, lab in rows
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    whole = sorted((i, lab, tuple(math.floor(Fraction(x) * scale) for x in v), v) for i, lab, v in fine)
    asked = {}
    for i, lab, w, v in whole:
        if i % step == 0 and (i not in asked or (lab, v) < asked[i][::2]):
            asked[i] = lab, w, v
    out = []
    for i, (lab, w, _) in asked.items():
        score = lambda x: max(LEAST, min(MOST, sum(a * b for a, b in zip(w, x, strict=True))))  # noqa: B023, E731
        others = [(score(x), j, lj) for j, lj, x, _ in whole if j != i and len(x) == len(w)]
        others.sort(key=lambda r: (-r[0], r[1]))
        for p, pj, _ in [r for r in others if r[2] == lab][:positives]:
            fit = [(s, j) for s, j, lj in others if lj != lab and low * p <= 100 * s <= high * p][:negatives]
            out += [(i, pj, rank, j, p, s) for rank, (s, j) in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = cover_tree.hard_negatives(df, df.where(F.col("vec_id") % 50 == 0), **options)
    return sorted(map(tuple, out.collect()))


def near_centres(chance, n, dim, centres, labels=4, spread=0.1):
    middle = chance.normal(size=(centres, dim))
    return [
        (i, (middle[i % centres] + spread * chance.normal(size=dim)).tolist(), int(chance.integers(labels)))
        for i in range(n)
    ]


@pytest.mark.parametrize(("centres", "spread"), [(9, 0.1), (1, 1.0)])
def test_negatives_are_those_of_brute_force(spark, monkeypatch, centres, spread):
    """Several shards and blocks, with and without nearness in the vectors."""
    for name, value in (("SHARD_ROWS", 150), ("BLOCK_ROWS", 4), ("BLOCKS_AT_ONCE", 2), ("LEAF_ROWS", 8)):
        monkeypatch.setattr(cover_tree, name, value)
    rows = near_centres(np.random.default_rng(31), 900, 6, centres, spread=spread)
    got = found(spark, rows)
    assert got == brute(rows)
    assert len(got) > 50


def test_other_windows_and_counts(spark):
    rows = near_centres(np.random.default_rng(32), 300, 5, 4)
    options = {"positives": 2, "negatives": 7, "low_percent": 10, "high_percent": 100}
    assert found(spark, rows, scale=16.0, **options) == brute(rows, 50, 2, 7, 10, 100, 16)


def test_rows_that_take_no_part_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, i % 3 / 4], i % 2) for i in range(160)]
    rows += [(200, None, 1), (250, [1.0, None], 1), (300, [nan, 1.0], 0), (350, [inf, 1.0], 0), (400, [1.0, 0.5], None)]
    rows += [(None, [1.0, 0.5], 1), (450, [1.0, 0.5, 0.25], 1), (451, [1.0, 0.5, 0.5], 1), (452, [0.75, 0.5, 0.5], 0)]
    rows += [(50, [1.0, 0.5], 0), (50, [2.0, 0.25], 1), (150, [1.0, 0.0], 0), (500, [], 1), (501, [], 0), (550, [0.0, 0.0], 1)]
    assert found(spark, rows) == brute(rows)


def test_a_vector_of_most_rows(spark):
    """Only its smallest ids can be ranked, and only they are dealt."""
    rows = [(i, [0.5, 0.25, 0.125], i % 2) for i in range(3000)] + near_centres(np.random.default_rng(33), 200, 3, 3, 2)
    rows = [(i, v, lab) for i, (_, v, lab) in enumerate(rows)]
    assert found(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    chance = np.random.default_rng(34)
    rows = near_centres(chance, 120, 3, 3, 2)
    rows += [(200, [1e30, 1.0, -1e30], 0), (201, [1e30, 2.0, 1e30], 0), (202, [1e30, 1.5, 1e30], 1), (203, [3e8, 1.0, 2.0], 1)]
    rows += [(250, [1.0, 1e9, 1.0], 1), (251, [0.0, 1e9, 0.5], 1), (252, [0.5, 9e8, 0.0], 0), (300, [1e300, 0.0, 1.0], 0)]
    assert found(spark, rows) == brute(rows)


def test_products():
    chance = random.Random(35)
    for bits in (8, 20, 26, 30, 70):
        rows = [[float(chance.randrange(-(1 << bits), 1 << bits)) for _ in range(5)] for _ in range(9)]
        rows[3] = [1.0, 2.0, 3.0, 4.0, 5.0]
        whole = whole_numbers(rows, 1.0)
        exact = [[max(LEAST, min(MOST, sum(int(x) * int(y) for x, y in zip(a, b, strict=True)))) for b in rows[:4]] for a in rows]
        assert products(whole, whole[:4]).tolist() == exact


def test_tree_is_a_cover_tree(monkeypatch):
    monkeypatch.setattr(cover_tree, "LEAF_ROWS", 4)
    chance = np.random.default_rng(36)
    vectors = np.array([v for _, v, _ in near_centres(chance, 500, 4, 12, spread=0.02)]) * 256
    points, most = cover_tree.augmented(vectors)
    assert np.allclose((points**2).sum(axis=1), most**2)
    labels = chance.integers(0, 5, 500)
    order, nodes = cover_tree.build_tree(points, labels)
    assert sorted(order.tolist()) == list(range(500))
    for node in nodes:
        rows = order[node["start"] : node["stop"]]
        far = np.sqrt(((points[rows] - points[rows[0]]) ** 2).sum(axis=1))
        assert far.max() == node["radius"]
        assert (node["label_low"], node["label_high"]) == (labels[rows].min(), labels[rows].max())
        if node["first"] >= 0:
            children = nodes[node["first"] : node["last"]]
            level = cover_tree.BASE ** (math.ceil(math.log(node["radius"]) / math.log(cover_tree.BASE)) - 1)
            centres = points[order[children["start"]]]
            apart = np.sqrt(((centres[:, None] - centres) ** 2).sum(axis=2)) + np.eye(len(centres)) * 1e9
            assert children["start"][0] == node["start"] and apart.min() > level >= children["radius"].max()


def test_nodes_outside_of_windows_are_skipped():
    """On vectors in clusters a small share of the rows is scored."""
    rows = near_centres(np.random.default_rng(37), 6000, 8, 60, spread=0.05)
    pdf = pd.DataFrame(rows, columns=["id", "v", "label"]).assign(shard=1)
    tree = cover_tree._tree_row(256.0)(pdf).iloc[0]
    block = cover_tree._block_row(256.0)(pdf.iloc[:20])
    block = next(iter(cover_tree._ask_nearest([block]))).iloc[0]
    search = cover_tree.Search(tree, block, 5, True)
    search.visit()
    assert search.scored < 0.1 * 20 * 6000
    best = products(search.queries, search.points)
    for q in range(20):
        fits = (search.labels == search.query_labels[q]) & (search.ids != search.query_ids[q])
        expected = sorted(zip((-best[q][fits]).tolist(), search.ids[fits].tolist(), strict=True))[:5]
        own = search.window == q
        assert list(zip((-search.score_of[own]).tolist(), search.vec_id[own].tolist(), strict=True)) == expected


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cover_tree.hard_negatives(empty, empty).collect() == []
    rows = near_centres(np.random.default_rng(38), 120, 4, 2)
    names = "id v nth dim pivot parts shard block radius length centre own name low high score rank key".split()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("own") for n in names})
    out = cover_tree.hard_negatives(df, df.where("vec_id % 50 = 0"))
    assert sorted(map(tuple, out.collect())) == brute(rows)


def test_query(spark, tmp_path):
    rows = near_centres(np.random.default_rng(39), 400, 5, 6, labels=10)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = REGISTRY["op13_cover_tree"](spark, str(tmp_path))
    assert out.dtypes[2] == ("rank", "int")
    moved = [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows]
    assert sorted(map(tuple, out.collect())) == brute(moved)
