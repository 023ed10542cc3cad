"""Mixes sources to target weights, by exact quotas and a hypergeometric splitting tree.

Each source's documents are dealt by hash to blocks of about a thousand.  A
source's target is a whole number of passes over it plus a rest; the rest is a
run of its blocks in a permuted order, with the last one cut between documents.
So the draws of a source are numbered, and none is drawn twice in a pass.  The
output shards get their shares of the sources' quotas by splitting the counts in
two again and again, each time by a multivariate hypergeometric draw with random
numbers that the node's place fixes, so a rerun gives the same mix.  A shard takes
the next draws of each source, in the permuted order, and is shuffled by itself.

Sources are a table like others, however many: their targets come from a few sums
over it, large nodes of the tree are split by groups of sources, and a node holds only
sources with draws.  Only sums come to the driver.  A source that holds most rows is
many blocks, whose running sums are taken in ranges of about 4,096; rows equal in all
columns are numbered, so that they spread over blocks too.

Defined results: a null or blank text has size 0 and is drawn like others, which
takes no words; null is a source of its own, the last; null and repeated ids are
documents by themselves, named by all their columns; rows equal in all of them
have draws each; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import null_safe, row_digest, words, written
from .word_codes import release_memory

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
BLOCK_DOCUMENTS = 1024
BLOCKS_PER_SHARD = 16
#: Blocks or shards summed by one task, shards whose subtree one task splits, and sources of one draw.
BLOCKS_AT_ONCE = 4096
SUBTREE_SHARDS = 4096
SOURCES_AT_ONCE = 4096
SEED = 20240229


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what is cut is shared again."""
    out, open_ones, rest = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while open_ones:
        weight = sum(weights[i] for i in open_ones)
        over = [i for i in open_ones if rest * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_ones:
                out[i] = rest * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
        rest -= sum(out[i] for i in over)
        open_ones = [i for i in open_ones if i not in set(over)]
    return out


def with_targets(sources: DataFrame, most: float) -> DataFrame:
    """``targets`` for a table of sources (words, weight): the level is found by sums over it, a round for each.

    Levels rise, so a source that is cut stays cut; the rounds end when no other one is.
    """
    total = sources.agg(F.sum("words").alias("words")).first()["words"] or 0
    full = F.lit(float(most)) * F.col("words")
    rest, weight, cut = float(total), sources.agg(F.sum("weight").alias("w")).first()["w"] or 0.0, 0
    while weight:
        share = F.lit(rest) * F.col("weight") / F.lit(float(weight))
        over = share > full
        now = sources.agg(
            F.count_if(over).alias("cut"), F.sum(F.when(over, full)).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("open")
        ).first()
        if now["cut"] == cut:
            return sources.withColumn("target", F.when(over, full).otherwise(share))
        rest, weight, cut = float(total) - now["full"], now["open"] or 0.0, now["cut"]
    return sources.withColumn("target", full)


def split(counts: np.ndarray, low: int, high: int, seed: Sequence[int]) -> np.ndarray:
    """How many draws of each source go to the shards low..middle of a node's low..high."""
    left = int(counts.sum()) * ((low + high) // 2 - low) // (high - low)
    return np.random.default_rng([*seed, low, high]).multivariate_hypergeometric(counts, left, method="marginals")


def subtree(low: int, high: int, sources: np.ndarray, counts: np.ndarray, seed: int) -> tuple[np.ndarray, ...]:
    """(source, shard, draws) of all shards under a node."""
    done: list[tuple] = []
    todo = [(low, high, sources, counts.astype(np.int64))]
    while todo:
        low, high, sources, counts = todo.pop()
        some = counts > 0
        sources, counts = sources[some], counts[some]
        if high - low == 1:
            done.append((sources, np.full(len(sources), low), counts))
        elif len(sources):
            mine, middle = split(counts, low, high, (seed, 0)), (low + high) // 2
            todo += [(low, middle, sources, mine), (middle, high, sources, counts - mine)]
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*done, strict=True)) if done else (np.empty(0, np.int64),) * 3


NODE = "low long, high long, _src long, _count long"


def _subtrees(seed: int):
    def grown(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_src")
        low, high = int(pdf["low"].iloc[0]), int(pdf["high"].iloc[0])
        src, shard, quota = subtree(low, high, pdf["_src"].to_numpy(np.int64), pdf["_count"].to_numpy(np.int64), seed)
        release_memory()
        return pd.DataFrame({"_src": src, "shard": shard, "_quota": quota})

    return grown


def _split_groups(seed: int):
    """The draws of each group of sources that go left at a node."""

    def halved(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_group")
        low, high = int(pdf["low"].iloc[0]), int(pdf["high"].iloc[0])
        return pdf[["low", "high", "_group"]].assign(_left=split(pdf["_all"].to_numpy(np.int64), low, high, (seed, 1)))

    return halved


def _split_sources(seed: int):
    """The two children's draws of the sources of one group, as many on the left as the group has there."""

    def halved(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_src")
        low, high, group = (int(pdf[c].iloc[0]) for c in ("low", "high", "_group"))
        counts, middle = pdf["_count"].to_numpy(np.int64), (low + high) // 2
        rng = np.random.default_rng([seed, 2, low, high, group])
        mine = rng.multivariate_hypergeometric(counts, int(pdf["_left"].iloc[0]), method="marginals")
        sides = [
            pd.DataFrame({"low": a, "high": b, "_src": pdf["_src"].to_numpy(), "_count": n})
            for a, b, n in ((low, middle, mine), (middle, high, counts - mine))
        ]
        both = pd.concat(sides, ignore_index=True)
        return both[both["_count"] > 0]

    return halved


def shard_quotas(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """(_src, shard, _quota) from ``counts`` (_src, _count): the splitting tree, from the root down.

    Nodes of many shards are split in rounds, each a table: first the draws of groups of
    sources are dealt to the children, then within each group those of its sources, which
    together is the same multivariate draw.  A node of few shards, and so of few draws,
    is split to its leaves by one task.  Sources without draws in a node leave it.
    """
    nodes = counts.where("_count > 0").select(
        F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "_src", "_count"
    )
    width = shards
    while width > SUBTREE_SHARDS:
        nodes = written(nodes, "mixing-nodes").withColumn("_group", F.floor(F.col("_src") / SOURCES_AT_ONCE))
        groups = nodes.groupBy("low", "high", "_group").agg(F.sum("_count").alias("_all"))
        left = groups.groupBy("low", "high").applyInPandas(_split_groups(seed), "low long, high long, _group long, _left long")
        left, same = null_safe(left, "low", "high", "_group")
        nodes = (
            nodes.join(left, same)
            .select("low", "high", "_group", "_src", "_count", "_left")
            .groupBy("low", "high", "_group")
            .applyInPandas(_split_sources(seed), NODE)
        )
        width = -(-width // 2)
    return nodes.groupBy("low", "high").applyInPandas(_subtrees(seed), "_src long, shard long, _quota long")


def running(df: DataFrame, by: Sequence[str], place: Column, sums: Sequence[str], ranges: Column) -> DataFrame:
    """``df`` with ``<c>_before`` for each of ``sums``: the sum over the rows of a group that come before, by ``place``.

    ``place`` is a 64-bit number, different for all rows of a group; ``ranges`` says into how many ranges of it
    a group is cut.  A task sums one range; the ranges' totals give what stands before each.
    """
    at = F.least(F.floor((place.cast("double") / 2.0**64 + 0.5) * ranges), ranges - 1)
    rows = df.withColumns({"_place": place, "_range": at})
    totals = rows.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_{c}_all") for c in sums])
    ahead = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*by, "_range", *[F.coalesce(F.sum(f"_{c}_all").over(ahead), F.lit(0)).alias(f"_{c}_base") for c in sums])
    bases, same = null_safe(bases, *by, "_range")
    inside = Window.partitionBy(*by, "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    within = rows.withColumns({f"_{c}_in": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    return within.join(bases, same).select(
        *df.columns, *[(F.col(f"_{c}_base") + F.col(f"_{c}_in")).alias(f"{c}_before") for c in sums]
    )


def _numbered_sources(stats: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Sources with their number by code point, null last, and their weight."""
    in_order = stats.repartitionByRange(F.col("source").isNull(), F.col("source")).sortWithinPartitions(
        F.col("source").isNull(), F.col("source")
    )
    # Partition in the upper bits, place in it below.
    placed = written(in_order.withColumn("_id", F.monotonically_increasing_id()), "mixing-sources")
    part, place = F.shiftrightunsigned("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_part": part, "_place": place})
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each partition.
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    numbered = placed.join(bases, F.col("_part") == F.col("_p")).withColumn("_src", F.col("_base") + F.col("_place"))
    each = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.get(each, (F.col("_src") % len(weights)).cast("int"))
    return written(numbered.select("source", "words", "docs", "_src", weight.alias("weight")), "mixing-numbered")


def _name(docs: DataFrame) -> Column:
    """128 bits of all columns of a row."""
    return F.unhex(row_digest(*(F.col(f"`{c}`") for c in docs.columns)))


def _with_copies(sized: DataFrame) -> DataFrame:
    """Rows with ``_copy``, their number among rows equal in all columns, so that equal rows differ.

    Equal rows are counted for each task that wrote them; a task then makes those of one count.
    """
    columns = [c for c in sized.columns if c != "_part"]
    counted = sized.groupBy(*columns, "_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*columns).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_n").over(ahead), F.lit(0))
    numbers = F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1))
    return counted.withColumn("_first", first).withColumn("_copy", numbers).select(*columns, "_copy")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_PASSES,
    seed: int = SEED,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, its draws and its name.

    ``name`` is 128 bits of all columns of ``docs``.  ``draws`` is an array of (pass, shard, place): the document stands in ``shard``
    at the rank of ``place``.  Weights repeat over the sources, which are ordered by
    code point.
    """
    sized = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.size(words(F.coalesce(F.col(text), F.lit("")))).cast("long").alias("size"),
            F.xxhash64(F.col(doc_id), F.lit(seed), F.col(text)).alias("_key"),
            _name(docs).alias("name"),
            F.spark_partition_id().alias("_part"),
        ),
        "mixing-sizes",
    )
    stats = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
    aimed = with_targets(_numbered_sources(stats, weights), most)
    passes = F.when(F.col("words") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("words")))).otherwise(0)
    sources = written(
        aimed.withColumn("_passes", passes.cast("int")).select(
            "_src",
            F.col("source").alias("_source"),
            F.col("words").alias("source_size"),
            "target",
            "_passes",
            F.bround(F.col("target") - F.col("_passes") * F.col("words")).cast("long").alias("_rest"),
            F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK_DOCUMENTS)).cast("long").alias("_n_blocks"),
        ),
        "mixing-targets",
    )
    key = F.xxhash64("_key", "_copy")
    rows = written(
        _with_copies(sized)
        .join(sources, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_key", key)
        .withColumn("_block", F.pmod(F.col("_key"), F.col("_n_blocks")))
        .drop("_source"),
        "mixing-rows",
    )
    ranges = F.ceil(F.col("_n_blocks") / BLOCKS_AT_ONCE)
    blocks = (
        rows.groupBy("_src", "_block")
        .agg(
            F.sum("size").alias("_words"),
            F.first("_rest").alias("_left"),
            F.first("_passes").alias("_passes"),
            F.first("_n_blocks").alias("_n_blocks"),
        )
        .withColumn("_one", F.lit(1).cast("long"))
    )
    blocks = running(blocks, ["_src"], F.xxhash64("_block", F.lit(seed)), ["_words", "_one"], ranges)
    blocks = written(
        blocks.select(
            "_src",
            "_block",
            "_left",
            "_passes",
            F.col("_one_before").alias("_rank"),
            F.col("_words_before").alias("_from"),
            (F.col("_words_before") < F.col("_left")).alias("_some"),
        ),
        "mixing-blocks",
    )
    quotas = written(
        blocks.groupBy("_src").agg(
            (F.sum(F.col("_some").cast("int")) + F.sum("_passes")).alias("_count"), F.count(F.lit(1)).alias("_in_pass")
        ),
        "mixing-quotas",
    )
    draws = quotas.agg(F.sum("_count").alias("n")).first()["n"] or 0
    shards = max(1, -(-draws // BLOCKS_PER_SHARD))
    quota = written(shard_quotas(quotas.select("_src", "_count"), shards, seed), "mixing-shards")
    # Shards in order, spread evenly over the 64 bits that ranges are cut from.
    step = min((1 << 63) - 1, ((1 << 64) - 1) // shards)
    spread = (F.col("shard") - F.lit(shards // 2)) * F.lit(step)
    upto = running(quota, ["_src"], spread, ["_quota"], F.lit(-(-shards // BLOCKS_AT_ONCE)))
    numbered = upto.select(
        "_src",
        "shard",
        F.explode(F.sequence(F.col("_quota_before"), F.col("_quota_before") + F.col("_quota") - 1)).alias("_number"),
    )
    in_pass, same = null_safe(quotas.select("_src", "_in_pass"), "_src")
    drawn = (
        blocks.join(in_pass, same)
        .withColumn("_last", F.col("_passes") - F.when(F.col("_some"), 0).otherwise(1))
        .where("_last >= 0")
        .withColumn("_pass", F.explode(F.sequence(F.lit(0), F.col("_last"))))
        .withColumn("_number", F.col("_pass") * F.col("_in_pass") + F.col("_rank"))
        .drop("__src")
    )
    placed = (
        drawn.join(numbered, ["_src", "_number"])
        .groupBy("_src", "_block")
        .agg(F.collect_list(F.struct(F.col("_pass"), "shard")).alias("_draws"))
    )
    cuts = blocks.select("_src", "_block", (F.col("_left") - F.col("_from")).alias("_cut"))
    inside = Window.partitionBy("_src", "_block").orderBy("_key", "size", F.col("doc_id").asc_nulls_first(), "name", "_copy")
    whole = Window.partitionBy("_src", "_block")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    none = F.array().cast("array<struct<_pass:int,shard:bigint>>")
    real = F.filter(F.coalesce("_draws", none), lambda d: (d["_pass"] < F.col("_passes")) | F.col("_inside"))
    draws = F.transform(
        real,
        lambda d: F.struct(
            d["_pass"].alias("pass"),
            d["shard"].alias("shard"),
            F.xxhash64(F.col("_key"), d["_pass"], d["shard"]).alias("place"),
        ),
    )
    return (
        rows.join(cuts, ["_src", "_block"])
        .join(placed, ["_src", "_block"], "left")
        # Past the cut of its source's last block, only the document that fits the rest best has a draw.
        .withColumn("_upto", upto)
        .withColumn("_nth", F.row_number().over(inside))
        .withColumn("_gone", F.max(F.when(F.col("_upto") <= F.col("_cut"), F.col("_upto"))).over(whole))
        .withColumn("_open", F.col("_cut") - F.coalesce("_gone", F.lit(0)))
        .withColumn("_gap", F.when(F.col("_upto") > F.col("_cut"), F.abs(F.col("size") - F.col("_open"))))
        .withColumn("_best", F.min(F.when(F.col("_gap") < F.col("_open"), F.struct("_gap", "_nth"))).over(whole))
        .withColumn("_inside", (F.col("_upto") <= F.col("_cut")) | (F.col("_nth") == F.col("_best")["_nth"]))
        .withColumn("_inside", F.coalesce("_inside", F.lit(False)))
        .select("doc_id", "source", "size", "source_size", "target", draws.alias("draws"), "name")
    )


def taken(mixed: DataFrame) -> DataFrame:
    """The mix's digest: doc_id, size, source_size, target, and the words taken, repeats counted."""
    words_taken = (F.col("size") * F.size("draws")).cast("long")
    return mixed.select("doc_id", "size", "source_size", "target", words_taken.alias("taken"))


def drawn_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs``, which ``mixed`` is the mix of, as often as they are drawn, shard by shard, each shuffled."""
    # Rows of one name are equal, so any of them stands for all and takes the draws of all.
    own = mixed.select(F.col("name").alias("__tl_drawn"), F.explode("draws").alias("__tl_draw"))
    once = docs.withColumn("__tl_name", _name(docs)).dropDuplicates(["__tl_name"])
    return (
        once.join(own, F.col("__tl_name") == F.col("__tl_drawn"))
        .repartition(F.col("__tl_draw.shard"))
        .sortWithinPartitions("__tl_draw.shard", "__tl_draw.place")
        .drop("__tl_name", "__tl_drawn", "__tl_draw")
    )
