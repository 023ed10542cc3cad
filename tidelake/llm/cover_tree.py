"""Hard negatives by windows of inner products, from cover trees.

An anchor's positives are the rows of its label with the largest products; its hard
negatives with a positive are the rows of other labels whose product lies in a window
under the positive's.  Both are searches for the k largest products in a window.

Trees.  Rows are dealt to shards of about 8,192 by the nearest of a few sampled
pivots.  A task augments the vectors of a shard by one component, so that all have
the same length M, and builds a cover tree: a ball's centres of the next level are
farther apart than that level's radius, which is 1.3 times smaller, and cover the
ball.  Nodes keep the radius that their rows have.  On the sphere a covering radius is
an angle, so the products of a query with a node's rows lie between
|q| M cos(angle + covering angle) and |q| M cos(angle - covering angle).  Nodes
outside of all windows, or under their k-th products so far, or without a wanted
label, are skipped; the others are visited best first, and leaves are scored exactly.
Where 64 centres of a level don't cover half of a ball it is a leaf: its rows
have no nearness that a bound could use.

Search.  Anchors stand in blocks of up to 1,024 of one pivot.  A block visits the shard
nearest to it first; the k-th products there are floors for the others, and pairs of
a block and a shard whose balls can't reach any window are dropped before trees are
sent.  A task holds one tree and up to 16 blocks.

Skew.  Of rows with one label and vector only the smallest ids can be ranked; they
are picked before the shuffle, so a vector of a third of all rows is a few rows.

Sample: at most 256 pivots, those with the smallest hash of their id.  Every row is in
a tree and every score is exact, so recall is 1.

Defined results: rows without id or label, and vectors that are null or hold null
or non-finite components, take no part.  Rows equal in id, label and vector are one.  A
repeated id asks once, with its smallest label and vector; its other rows are not its
positives or negatives.  Vectors of different lengths are not compared.  Scores beyond 64
bits count as the largest or smallest number of 64 bits.  An empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import finite_vector, written
from .exact_products import LEAST, MOST, products, whole_numbers

SHARD_ROWS = 8192
BLOCK_ROWS = 1024
BLOCKS_AT_ONCE = 16
MAX_PIVOTS = 256
LEAF_ROWS = 64
TRIED_CENTRES = 64
BASE = 1.3
#: Scores held at once.
CELLS = 1 << 21
BALL = "dim int, centre array<double>, radius double, length double"
TREE = f"shard long, {BALL}, ids binary, labels binary, vectors binary, nodes binary, most double"
BLOCK = f"block long, {BALL}, ids binary, labels binary, vectors binary"
ASKED = f"{BLOCK}, owner binary, name binary, low binary, high binary"
FOUND = "block long, query_id long, name long, vec_id long, score long"
#: A node: rows start..stop, of which the first is its centre; children first..last; radius and labels.
NODE = np.dtype([(c, np.int64) for c in ("start", "stop", "first", "last", "label_low", "label_high")] + [("radius", np.float64)])


def augmented(points: np.ndarray) -> tuple[np.ndarray, float]:
    """(points with a component that makes all as long as the longest, that length)."""
    squares = (points**2).sum(axis=1)
    most = float(squares.max(initial=0))
    return np.column_stack([points, np.sqrt(np.maximum(0, most - squares))]), float(np.sqrt(most))


def build_tree(points: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row order, nodes) of a cover tree; rows of a node are together, its centre first."""
    order = np.arange(len(points))
    nodes: list[tuple] = []

    def add(start: int, stop: int) -> tuple[int, np.ndarray]:
        rows = order[start:stop]
        far = np.sqrt(((points[rows] - points[rows[0]]) ** 2).sum(axis=1))
        own = labels[rows]
        nodes.append((start, stop, -1, -1, own.min(), own.max(), float(far.max())))
        return len(nodes) - 1, far

    todo = [add(0, len(points))]
    while todo:
        node, far = todo.pop()
        start, stop, *_, radius = nodes[node]
        if stop - start <= LEAF_ROWS or not 0 < radius < np.inf:
            continue
        # The level's radius is the largest power under the ball's.
        cover = BASE ** (np.ceil(np.log(radius) / np.log(BASE)) - 1)
        rows = order[start:stop].copy()
        group = np.where(far <= cover, 0, -1)
        groups = 1
        while len(left := np.flatnonzero(group < 0)):
            if groups == TRIED_CENTRES and 2 * len(left) > len(rows):
                break
            own = points[rows[left]]
            group[left[((own - own[0]) ** 2).sum(axis=1) <= cover**2]] = groups
            group[left[0]] = groups
            groups += 1
        if (group < 0).any():
            continue
        by = np.argsort(group, kind="stable")
        order[start:stop] = rows[by]
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(group[by]) != 0)), len(rows)) + start
        children = [add(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        nodes[node] = (start, stop, children[0][0], children[-1][0] + 1, *nodes[node][4:])
        todo += children
    return order, np.array(nodes, NODE)


class Search:
    """The k largest products in each window of a block's anchors, over one tree."""

    def __init__(self, tree: pd.Series, block: pd.Series, k: int, same_label: bool) -> None:
        dim = int(tree["dim"])
        self.ids, self.labels = (np.frombuffer(tree[c], np.int64) for c in ("ids", "labels"))
        self.points = np.frombuffer(tree["vectors"], np.float64).reshape(len(self.ids), dim)
        self.nodes, self.most = np.frombuffer(tree["nodes"], NODE), float(tree["most"])
        self.query_ids, self.query_labels = (np.frombuffer(block[c], np.int64) for c in ("ids", "labels"))
        self.queries = np.frombuffer(block["vectors"], np.float64).reshape(len(self.query_ids), dim)
        self.lengths = np.sqrt((self.queries**2).sum(axis=1))
        self.owner, self.low, self.high = (np.frombuffer(block[c], np.int64) for c in ("owner", "low", "high"))
        self.floor = self.low.copy()
        self.k, self.same_label, self.scored = k, same_label, 0
        none = np.empty(0, np.int64)
        self.window, self.vec_id, self.score_of = none, none, none

    def bounds(self, node, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) that a product of the anchors ``some`` with a row of the node can be, with room for rounding."""
        size = self.lengths[some] * self.most
        with np.errstate(all="ignore"):
            angle = np.arccos(np.clip(self.queries[some] @ self.points[node["start"]] / size, -1, 1))
            cover = 2 * np.arcsin(min(1.0, node["radius"] / (2 * self.most)))
            slack = 1e-7 * size + 1e-6
            low = size * np.cos(np.minimum(np.pi, angle + cover)) - slack
            high = size * np.cos(np.maximum(0, angle - cover)) + slack
        # Lengths past the range of doubles bound nothing.
        return np.nan_to_num(low, nan=-np.inf), np.nan_to_num(high, nan=np.inf)

    def wanted(self, node, active: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which of the windows ``active`` the node may serve, by bounds of their anchors."""
        own = self.query_labels[self.owner[active]]
        if self.same_label:
            fits = (node["label_low"] <= own) & (own <= node["label_high"])
        else:
            fits = (node["label_low"] != own) | (own != node["label_high"])
        return active[fits & (high >= self.floor[active]) & (low <= self.high[active])]

    def visit(self) -> None:
        todo = [(0, np.arange(len(self.owner)))]
        while todo:
            at, active = todo.pop()
            node = self.nodes[at]
            low, high = self.bounds(node, self.owner[active])
            active = self.wanted(node, active, low, high)
            if not len(active):
                continue
            if node["first"] < 0:
                self.score(int(node["start"]), int(node["stop"]), active)
                continue
            children = range(int(node["first"]), int(node["last"]))
            best = {c: float(np.mean(self.queries[self.owner[active]] @ self.points[self.nodes[c]["start"]])) for c in children}
            # The last one is visited next.
            todo += [(c, active) for c in sorted(children, key=best.get)]

    def score(self, start: int, stop: int, active: np.ndarray) -> None:
        step = max(1, CELLS // (stop - start))
        for x in range(0, len(active), step):
            some = active[x : x + step]
            anchors, back = np.unique(self.owner[some], return_inverse=True)
            own = products(self.queries[anchors], self.points[start:stop])
            self.scored += own.size
            fits = self.labels[start:stop] == self.query_labels[anchors][:, None]
            fits = (fits if self.same_label else ~fits) & (self.ids[start:stop] != self.query_ids[anchors][:, None])
            scores, fits = own[back], fits[back]
            fits &= (scores >= self.floor[some][:, None]) & (scores <= self.high[some][:, None])
            if scores.shape[1] > self.k:
                # At most k better ones: under the k-th of these rows nothing counts.
                kth = np.partition(np.where(fits, scores, LEAST), -self.k, axis=1)[:, -self.k]
                fits &= scores >= kth[:, None]
            row, place = np.nonzero(fits)
            self.keep(some[row], self.ids[start:stop][place], scores[row, place])

    def keep(self, window: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> None:
        """Merge what was found; the k best of each window stay and raise its floor."""
        window, vec_id, score = (
            np.concatenate(x) for x in ((self.window, window), (self.vec_id, vec_id), (self.score_of, score))
        )
        order = np.lexsort((vec_id, ~score, window))
        window, vec_id, score = window[order], vec_id[order], score[order]
        head = np.flatnonzero(np.append(True, window[1:] != window[:-1])[: len(window)])
        nth = np.arange(len(window)) - np.repeat(head, np.diff(np.append(head, len(window))))
        last = nth == self.k - 1
        self.floor[window[last]] = np.maximum(self.floor[window[last]], score[last])
        stays = nth < self.k
        self.window, self.vec_id, self.score_of = window[stays], vec_id[stays], score[stays]


def _ball(vectors: np.ndarray) -> dict:
    centre = vectors.mean(axis=0)
    with np.errstate(over="ignore", invalid="ignore"):
        radius = np.sqrt(((vectors - centre) ** 2).sum(axis=1).max(initial=0))
        length = np.sqrt((centre**2).sum())
    return {"dim": vectors.shape[1], "centre": [centre.tolist()], "radius": radius, "length": length}


def _tree_row(scale: float):
    def tree_row(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "label"])
        vectors = whole_numbers(pdf["v"].tolist(), scale)
        ids, labels = pdf["id"].to_numpy(np.int64), pdf["label"].to_numpy(np.int64)
        with np.errstate(over="ignore", invalid="ignore"):
            points, most = augmented(vectors)
            order, nodes = build_tree(points, labels)
        return pd.DataFrame(
            {
                "shard": pdf["shard"].iloc[:1].to_numpy(),
                **_ball(vectors),
                "ids": [ids[order].tobytes()],
                "labels": [labels[order].tobytes()],
                "vectors": [vectors[order].tobytes()],
                "nodes": [nodes.tobytes()],
                "most": most,
            }
        )

    return tree_row


def _block_row(scale: float):
    def block_row(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        vectors = whole_numbers(pdf["v"].tolist(), scale)
        return pd.DataFrame(
            {
                "block": pdf["shard"].iloc[:1].to_numpy(),
                **_ball(vectors),
                "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                "labels": [pdf["label"].to_numpy(np.int64).tobytes()],
                "vectors": [vectors.tobytes()],
            }
        )

    return block_row


def _asking(owner: np.ndarray, name: np.ndarray, low: list[int], high: list[int]) -> dict:
    return {
        "owner": [np.array(owner, np.int64).tobytes()],
        "name": [np.array(name, np.int64).tobytes()],
        "low": [np.array(low, np.int64).tobytes()],
        "high": [np.array(high, np.int64).tobytes()],
    }


def _ask_nearest(blocks: Iterable[pd.DataFrame]):
    """One window without ends for each anchor."""
    for pdf in blocks:
        for i in range(len(pdf)):
            n = len(pdf["ids"].iloc[i]) // 8
            yield pdf.iloc[i : i + 1].assign(**_asking(np.arange(n), np.zeros(n), [LEAST] * n, [MOST] * n))


def _ask_under(low_percent: int, high_percent: int):
    """A window for each anchor and positive of a block."""

    def ask(blocks: pd.DataFrame, positives: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(blocks["ids"].iloc[0], np.int64)
        owner = np.searchsorted(ids, positives["query_id"].to_numpy(np.int64))
        scores = [int(s) for s in positives["score"]]
        # low_percent * positive <= 100 * negative <= high_percent * positive, for whole numbers.
        low, high = [-(-low_percent * s // 100) for s in scores], [high_percent * s // 100 for s in scores]
        return blocks.assign(**_asking(owner, positives["nth"].to_numpy(np.int64), low, high))

    return ask


def _raise_floors(k: int):
    """A block whose windows begin at the k-th products that are known."""

    def told(blocks: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        block = blocks.iloc[0]
        ids = np.frombuffer(block["ids"], np.int64)
        owner, name = (np.frombuffer(block[c], np.int64) for c in ("owner", "name"))
        low = np.frombuffer(block["low"], np.int64).copy()
        best = known.sort_values("score", ascending=False).groupby(["query_id", "name"])["score"]
        kth = best.nth(k - 1)
        at = known.loc[kth.index, ["query_id", "name"]].assign(kth=kth)
        windows = pd.DataFrame({"query_id": ids[owner], "name": name, "place": np.arange(len(owner))})
        at = at.merge(windows, on=["query_id", "name"])
        low[at["place"].to_numpy()] = np.maximum(low[at["place"].to_numpy()], at["kth"].to_numpy(np.int64))
        return blocks.assign(low=[low.tobytes()])

    return told


def _search(k: int, same_label: bool):
    def search(trees: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c.split()[0]: np.empty(0, np.int64) for c in FOUND.split(", ")})]
        for _, block in blocks.iterrows() if len(trees) else ():
            found = Search(trees.iloc[0], block, k, same_label)
            found.visit()
            name = np.frombuffer(block["name"], np.int64)
            out.append(
                pd.DataFrame(
                    {
                        "block": int(block["block"]),
                        "query_id": found.query_ids[found.owner[found.window]],
                        "name": name[found.window],
                        "vec_id": found.vec_id,
                        "score": found.score_of,
                    }
                )
            )
        return pd.concat(out, ignore_index=True)

    return search


def _dealt(rows: DataFrame, pivots: list[tuple], scale: float, most: int) -> DataFrame:
    """``rows`` with a shard: the nearest pivot, in parts of about ``most`` rows."""
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {len(v) for v in pivots}:
        numbers = np.array([i for i, v in enumerate(pivots) if len(v) == dim])
        by_dim[dim] = numbers, whole_numbers([list(pivots[i]) for i in numbers], scale)

    @F.pandas_udf("long")
    def nearest(vectors: pd.Series) -> pd.Series:
        out = np.full(len(vectors), -1, np.int64)
        dims = vectors.map(len).to_numpy()
        for dim in set(dims.tolist()) & set(by_dim):
            numbers, centres = by_dim[dim]
            at = np.flatnonzero(dims == dim)
            own = whole_numbers(vectors.iloc[at].tolist(), scale)
            with np.errstate(over="ignore", invalid="ignore"):
                far = (centres**2).sum(axis=1) - 2 * own @ centres.T
            out[at] = numbers[np.nan_to_num(far, nan=np.inf).argmin(axis=1)]
        return pd.Series(out)

    dealt = written(rows.withColumn("dim", F.size("v")).withColumn("pivot", nearest("v")), "cover-rows")
    parts = dealt.groupBy(F.col("dim").alias("_dim"), F.col("pivot").alias("_pivot")).agg(
        F.ceil(F.count(F.lit(1)) / most).alias("parts")
    )
    same = F.col("dim").eqNullSafe(F.col("_dim")) & F.col("pivot").eqNullSafe(F.col("_pivot"))
    return dealt.join(parts, same).withColumn(
        "shard", F.xxhash64("dim", "pivot", F.pmod(F.xxhash64("id", "label"), F.col("parts")))
    )


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: float = 256.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A negative's score is at least ``low_percent`` and at most ``high_percent`` of the
    positive's; higher scores come first, ties to the smaller id.
    """

    def taking_part(df: DataFrame) -> DataFrame:
        out = df.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
        return out.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite_vector(F.col("v")))

    # Of one label and vector, more ids than these are never ranked.
    fewest = Window.partitionBy("label", "v").orderBy("id")
    ranked = taking_part(rows).dropDuplicates(["id", "label", "v"]).withColumn("nth", F.row_number().over(fewest))
    ranked = ranked.where(F.col("nth") <= max(positives + 1, negatives + 1)).drop("nth")
    asked = taking_part(anchors).groupBy("id").agg(F.min(F.struct("label", "v")).alias("own")).select("id", "own.label", "own.v")
    candidates = written(ranked, "cover-candidates")
    n_pivots = min(MAX_PIVOTS, max(1, -(-candidates.count() // SHARD_ROWS)))
    pivots = [tuple(r["v"]) for r in candidates.orderBy(F.xxhash64("id"), "id", "label").limit(n_pivots).collect()]
    trees = written(
        _dealt(candidates, pivots, scale, SHARD_ROWS).groupBy("shard").applyInPandas(_tree_row(scale), TREE), "cover-trees"
    )
    blocks = written(
        _dealt(asked, pivots, scale, BLOCK_ROWS).groupBy("shard").applyInPandas(_block_row(scale), BLOCK), "anchor-blocks"
    )
    batches = max(1, -(-blocks.count() // BLOCKS_AT_ONCE))
    ball = ("dim", "centre", "radius", "length")
    shards = trees.select("shard", *[F.col(c).alias(f"_{c}") for c in ball])
    middle = F.aggregate(F.zip_with("centre", "_centre", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    reach = F.col("radius") * F.col("_length") + F.col("_radius") * F.col("length") + F.col("radius") * F.col("_radius")
    slack = 1e-9 * (reach + F.col("length") * F.col("_length")) + 1
    # Names and balls of blocks and shards only.
    pairs = written(
        blocks.select("block", *ball)
        .join(shards, F.col("dim") == F.col("_dim"))
        .select("block", "shard", middle.alias("middle"), (reach + slack).alias("reach")),
        "cover-pairs",
    )
    home = written(
        pairs.groupBy("block").agg(F.max_by("shard", F.struct("middle", "shard")).alias("shard")), "cover-home"
    )

    def searched(some: DataFrame, asking: DataFrame, k: int, same_label: bool) -> DataFrame:
        named = some.select(
            F.col("shard").alias("_shard"),
            F.col("block").alias("_block"),
            F.pmod(F.xxhash64("block"), F.lit(batches)).alias("_batch"),
        )
        groups = named.select(F.col("_shard").alias("_own"), F.col("_batch").alias("_part")).distinct()
        left = trees.join(groups, F.col("shard") == F.col("_own")).groupBy("_own", "_part")
        right = asking.join(named, F.col("block") == F.col("_block")).groupBy("_shard", "_batch")
        return left.cogroup(right).applyInPandas(_search(k, same_label), FOUND)

    def best(asking: DataFrame, k: int, same_label: bool, name: str) -> DataFrame:
        """The k best of each window: home first, then wherever its floor doesn't rule them out."""
        first = written(searched(home, asking, k, same_label), f"{name}-home")
        told = asking.groupBy("block").cogroup(first.groupBy("block")).applyInPandas(_raise_floors(k), ASKED)
        told = written(told, f"{name}-floors")
        ends = told.mapInPandas(_ends, "block long, floor double, ceiling double")
        open_pairs = (
            pairs.join(home.withColumn("_home", F.lit(1)), ["block", "shard"], "left")
            .where("_home IS NULL")
            .join(ends, "block")
            .where((F.col("middle") + F.col("reach") >= F.col("floor")) | F.isnan(F.col("middle") + F.col("reach")))
            .where((F.col("middle") - F.col("reach") <= F.col("ceiling")) | F.isnan(F.col("middle") - F.col("reach")))
        )
        rest = searched(open_pairs, told, k, same_label)
        in_window = Window.partitionBy("query_id", "name").orderBy(F.col("score").desc(), "vec_id")
        return first.union(rest).withColumn("rank", F.row_number().over(in_window)).where(F.col("rank") <= k)

    nearest = best(blocks.mapInPandas(_ask_nearest, ASKED), positives, True, "positives")
    nearest = written(nearest.select("block", "query_id", "vec_id", "score", F.col("rank").alias("nth")), "positives")
    under = blocks.groupBy("block").cogroup(nearest.groupBy("block"))
    asking = written(under.applyInPandas(_ask_under(low_percent, high_percent), ASKED), "negatives-asked")
    found = best(asking, negatives, False, "negatives")
    of_window = nearest.select(
        F.col("query_id").alias("_query"),
        F.col("nth").alias("_nth"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return found.join(of_window, (F.col("query_id") == F.col("_query")) & (F.col("name") == F.col("_nth"))).select(
        F.col("query_id").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _ends(blocks: Iterable[pd.DataFrame]):
    """The least floor and the highest end of a block's windows."""
    for pdf in blocks:
        for _, block in pdf.iterrows():
            low, high = (np.frombuffer(block[c], np.int64) for c in ("low", "high"))
            if len(low):
                yield pd.DataFrame({"block": [block["block"]], "floor": [float(low.min())], "ceiling": [float(high.max())]})
