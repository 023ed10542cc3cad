"""Exact top-k by inner product: a ball tree per shard, branch and bound.

Vectors are dealt to shards of about 8,192; a task builds each shard's ball tree
and keeps it as one row.  Queries stand in blocks of up to 4,096.  A block visits
one shard first, whose k-th score is a floor for every other shard; all other
(shard, block) pairs then skip each ball whose upper bound, the product with its
centre plus the query's length times its radius, is under the current k-th score.
Balls are visited in order of that bound.  The stated queries meet all rows, in
blocks: no row is paired with a row outside a task, and no task holds more than a
shard and a block.

Components are whole numbers held as doubles; products are exact, also past what
doubles or 64 bits hold: rows too large for that are multiplied as Python's integers,
they alone.  A score beyond 64 bits counts as the largest or smallest number of 64
bits.  Vectors of different lengths are not candidates for each other.

Defined results: vectors that are null or hold null or non-finite components, and
rows without an id, take no part.  A repeated id asks once, with its smallest
vector; as candidates, all rows count, and those with the query's own id do not.
Of rows equal in id and vector no more than k can be ranked; they are one row with
their number, and spread over no more than that.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import finite_vector, written
from .exact_products import LEAST, products, whole_numbers

SHARD_ROWS = 8192
BLOCK_ROWS = 4096
LEAF_ROWS = 128
NOBODY = np.iinfo(np.int64).max
TREE = (
    "dim int, shard long, ids binary, vectors binary, starts binary, stops binary, "
    "lefts binary, centres binary, radii binary"
)
BLOCK = "dim int, block long, ids binary, vectors binary"
FOUND = "dim int, block long, query_id long, vec_id long, score long, floor long"


def build_tree(vectors: np.ndarray) -> tuple[np.ndarray, list[int], list[int], list[int], np.ndarray, np.ndarray]:
    """(row order, starts, stops, left children, centres, radii) of a ball tree; a leaf's left child is -1.

    A ball is cut at the middle of its rows along the line between two far points.
    The right child follows the left one.
    """
    points = vectors.astype(np.float64)
    order = np.arange(len(points))
    starts, stops, lefts, centres, radii = [], [], [], [], []

    def add(start: int, stop: int) -> int:
        own = points[order[start:stop]]
        centre = own.mean(axis=0)
        starts.append(start)
        stops.append(stop)
        lefts.append(-1)
        centres.append(centre)
        radii.append(float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())))
        return len(starts) - 1

    todo = [add(0, len(points))]
    while todo:
        node = todo.pop()
        start, stop = starts[node], stops[node]
        if stop - start <= LEAF_ROWS or not 0 < radii[node] < np.inf:
            continue
        rows = order[start:stop]
        own = points[rows]
        far = own[((own - centres[node]) ** 2).sum(axis=1).argmax()]
        other = own[((own - far) ** 2).sum(axis=1).argmax()]
        middle = (stop - start) // 2
        order[start:stop] = rows[np.argpartition(own @ (other - far), middle)]
        lefts[node] = add(start, start + middle)
        todo += [lefts[node], add(start + middle, stop)]
    return order, starts, stops, lefts, np.array(centres), np.array(radii)


def _tree_row(scale: float):
    def tree_row(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        vectors = whole_numbers(pdf["v"].tolist(), scale)
        with np.errstate(over="ignore", invalid="ignore"):
            order, starts, stops, lefts, centres, radii = build_tree(vectors)
        return pd.DataFrame(
            {
                "dim": pdf["dim"].iloc[:1].to_numpy(),
                "shard": pdf["shard"].iloc[:1].to_numpy(),
                "ids": [pdf["id"].to_numpy(np.int64)[order].tobytes()],
                "vectors": [vectors[order].tobytes()],
                "starts": [np.array(starts, np.int64).tobytes()],
                "stops": [np.array(stops, np.int64).tobytes()],
                "lefts": [np.array(lefts, np.int64).tobytes()],
                "centres": [centres.tobytes()],
                "radii": [radii.tobytes()],
            }
        )

    return tree_row


def _block_row(scale: float):
    def block_row(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        return pd.DataFrame(
            {
                "dim": pdf["dim"].iloc[:1].to_numpy(),
                "block": pdf["block"].iloc[:1].to_numpy(),
                "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                "vectors": [whole_numbers(pdf["v"].tolist(), scale).tobytes()],
            }
        )

    return block_row


class Search:
    """The k best of one shard for a block of queries."""

    def __init__(self, tree: pd.Series, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> None:
        dim = int(tree["dim"])
        self.ids = np.frombuffer(tree["ids"], np.int64)
        self.vectors = np.frombuffer(tree["vectors"], np.float64).reshape(len(self.ids), dim)
        self.starts, self.stops, self.lefts = (np.frombuffer(tree[c], np.int64) for c in ("starts", "stops", "lefts"))
        self.centres = np.frombuffer(tree["centres"], np.float64).reshape(len(self.starts), dim)
        self.radii = np.frombuffer(tree["radii"], np.float64)
        self.query_ids, self.queries, self.k = query_ids, queries, k
        with np.errstate(over="ignore"):
            self.norms = np.sqrt((queries**2).sum(axis=1))
        self.scores = np.full((len(queries), k), LEAST)
        self.found = np.full((len(queries), k), NOBODY)
        self.kth = floors.copy()

    def bounds(self, node: int, active: np.ndarray) -> np.ndarray:
        """No product with a vector in the ball is larger, with room for rounding."""
        centre, radius = self.centres[node], self.radii[node]
        with np.errstate(over="ignore", invalid="ignore"):
            reach = self.norms[active] * radius
            slack = 1e-9 * (self.norms[active] * np.sqrt((centre**2).sum()) + reach) + 1e-6
            # Where numbers pass the range of doubles nothing is bounded.
            return np.nan_to_num(self.queries[active] @ centre + reach + slack, nan=np.inf)

    def visit(self) -> None:
        todo = [(0, np.arange(len(self.queries)))]
        while todo:
            node, active = todo.pop()
            active = active[self.bounds(node, active) >= self.kth[active]]
            if not len(active):
                continue
            left = int(self.lefts[node])
            if left < 0:
                self.score(int(self.starts[node]), int(self.stops[node]), active)
                continue
            children = sorted((left, left + 1), key=lambda c: float(self.bounds(c, active).sum()))
            todo += [(c, active) for c in children]

    def score(self, start: int, stop: int, active: np.ndarray) -> None:
        scores = products(self.queries[active], self.vectors[start:stop])
        ids = np.broadcast_to(self.ids[start:stop], scores.shape)
        # No row stands behind an empty place, which has the least score and this id.
        ids = np.where(self.query_ids[active][:, None] == ids, NOBODY, ids)
        scores[ids == NOBODY] = LEAST
        some = (scores >= self.kth[active][:, None]).any(axis=1)
        active, scores, ids = active[some], scores[some], ids[some]
        if not len(active):
            return
        all_scores = np.concatenate([self.scores[active], scores], axis=1)
        all_ids = np.concatenate([self.found[active], ids], axis=1)
        best = np.lexsort((all_ids, ~all_scores), axis=-1)[:, : self.k]
        self.scores[active] = np.take_along_axis(all_scores, best, axis=1)
        self.found[active] = np.take_along_axis(all_ids, best, axis=1)
        self.kth[active] = np.maximum(self.kth[active], self.scores[active, -1])


def _search(k: int):
    def search(trees: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if not len(trees) or not len(blocks):
            return pd.DataFrame({c.split()[0]: [] for c in FOUND.split(", ")})
        block = blocks.iloc[0]
        query_ids = np.frombuffer(block["ids"], np.int64)
        queries = np.frombuffer(block["vectors"], np.float64).reshape(len(query_ids), int(block["dim"]))
        floors = np.full(len(query_ids), LEAST)
        if block.get("floors") is not None:
            floors = np.frombuffer(block["floors"], np.int64)
        search = Search(trees.iloc[0], query_ids, queries, floors, k)
        search.visit()
        real = search.found != NOBODY
        row, place = np.nonzero(real & (search.scores >= floors[:, None]))
        return pd.DataFrame(
            {
                "dim": int(block["dim"]),
                "block": int(block["block"]),
                "query_id": query_ids[row],
                "vec_id": search.found[row, place],
                "score": search.scores[row, place],
                "floor": search.kth[row],
            }
        )

    return search


def _with_floors(blocks: pd.DataFrame, first: pd.DataFrame) -> pd.DataFrame:
    block = blocks.iloc[:1].copy()
    ids = np.frombuffer(block["ids"].iloc[0], np.int64)
    floors = np.full(len(ids), LEAST)
    floors[np.searchsorted(ids, first["query_id"].to_numpy(np.int64))] = first["floor"].to_numpy(np.int64)
    block["floors"] = [floors.tobytes()]
    return block


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: float = 64.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest integer products, ties to the smaller id."""

    def taking_part(df: DataFrame) -> DataFrame:
        out = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"))
        return out.where(F.col("id").isNotNull() & finite_vector(F.col("v")))

    equal = taking_part(vectors).groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies"))
    copies = F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int")))
    rows = written(equal.withColumn("copy", copies).select("id", "v", "copy", F.size("v").alias("dim")), "ball-rows")
    asked = taking_part(queries).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    n_blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    # Repeated ids may not land in one shard together, so that goes by the row.
    trees = written(
        rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)))
        .groupBy("dim", "shard")
        .applyInPandas(_tree_row(scale), TREE),
        "ball-trees",
    )
    blocks = written(
        asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
        .groupBy("dim", "block")
        .applyInPandas(_block_row(scale), BLOCK),
        "query-blocks",
    )
    # Names of shards and blocks only; written, so that they come apart from the trees.
    pairs = written(blocks.select("dim", "block").join(trees.select("dim", "shard"), "dim"), "top-k-pairs")
    home = pairs.groupBy("dim", "block").agg(F.min_by("shard", F.xxhash64("shard", "block")).alias("shard"))

    def searched(some: DataFrame, asking: DataFrame) -> DataFrame:
        left = trees.join(some, ["dim", "shard"]).groupBy("dim", "shard", "block")
        named = some.select(*[F.col(c).alias(f"_{c}") for c in ("dim", "shard", "block")])
        same = (F.col("dim") == F.col("_dim")) & (F.col("block") == F.col("_block"))
        right = asking.join(named, same).groupBy("_dim", "_shard", "_block")
        return left.cogroup(right).applyInPandas(_search(k), FOUND)

    first = written(searched(home, blocks), "top-k-first")
    told = blocks.groupBy("dim", "block").cogroup(first.groupBy("dim", "block")).applyInPandas(
        _with_floors, f"{BLOCK}, floors binary"
    )
    rest = searched(pairs.join(home, ["dim", "block", "shard"], "left_anti"), told)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        first.union(rest)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
