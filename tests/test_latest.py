"""Latest version per key, against a plain Python reading of the rule."""

from collections import defaultdict
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidelake.operators.latest import latest_by_key, update_by_key

SCHEMA = "k1 INT, k2 STRING, date DATE, v INT"
DAYS = [date(2025, 1, d) for d in (1, 2, 3)]

rows_strategy = st.lists(
    st.tuples(
        st.sampled_from([None, 1, 2]),
        st.sampled_from([None, "a"]),
        st.sampled_from([None, *DAYS]),
        st.sampled_from([None, 1, 2]),
    ),
    max_size=12,
)


def nulls_first(values):
    return tuple((v is not None, v) if v is not None else (False,) for v in values)


def expected_all(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[:2]].append(row)
    kept = []
    for group in groups.values():
        newest = max(group, key=lambda r: nulls_first([r[2]]))[2]
        kept += [r for r in group if r[2] == newest]
    return sorted(kept, key=nulls_first)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=nulls_first)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy)
def test_all_ties_stay(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(latest_by_key(df, ["k1", "k2"], "date")) == expected_all(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy)
def test_one_of_the_ties(spark, rows):
    best = {}
    for row in expected_all(rows):
        best[row[:2]] = max(best.get(row[:2], row), row, key=nulls_first)
    df = spark.createDataFrame(rows, SCHEMA)
    one = latest_by_key(df, ["k1", "k2"], "date", ties="one")
    assert one.columns == df.columns
    assert collected(one) == sorted(best.values(), key=nulls_first)


def test_idempotent(spark):
    rows = [(1, "a", DAYS[0], 1), (1, "a", DAYS[1], 2), (1, "a", DAYS[1], 3), (None, None, None, 4)]
    once = latest_by_key(spark.createDataFrame(rows, SCHEMA), ["k1", "k2"], "date")
    assert collected(latest_by_key(once, ["k1", "k2"], "date")) == collected(once)


@pytest.mark.parametrize("sides", ["small", "large"])
@pytest.mark.parametrize("ties", ["all", "one"])
@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=rows_strategy, new=rows_strategy)
def test_update_is_the_latest_of_both(spark, request, sides, ties, old, new):
    if sides == "large":
        request.getfixturevalue("large_tables")
    key, day = ["k1", "k2"], date(2025, 2, 1)
    current = latest_by_key(spark.createDataFrame(old, SCHEMA), key, "date", ties)
    newer = spark.createDataFrame([(k1, k2, day, v) for k1, k2, _, v in new], SCHEMA)
    assert collected(update_by_key(current, newer, key, "date", ties)) == collected(
        latest_by_key(current.unionByName(newer), key, "date", ties)
    )


def skewed(spark, first_day):
    return spark.range(0, 90_000, 1, 16).selectExpr(
        "IF(id % 3 = 0, -1, id) AS k", f"date'{first_day}' AS date", "id AS v"
    )


def test_unknown_tie_rule(spark):
    with pytest.raises(ValueError):
        latest_by_key(spark.createDataFrame([], SCHEMA), ["k1"], "date", ties="some")


@pytest.fixture
def small_skew(spark):
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {key: spark.conf.get(key) for key in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split_over_tasks(spark, small_skew, large_tables):
    """A third of all rows share one key and its newest date."""
    latest = latest_by_key(skewed(spark, "2025-01-01"), ["k"], "date")
    assert len(latest.collect()) == 90_000
    assert "SortMergeJoin(skew=true)" in executed(latest)


def test_an_update_splits_a_hot_key_and_does_not_shuffle_the_new_rows(
    spark, folder, small_skew, large_tables
):
    skewed(spark, "2025-01-01").write.parquet(f"{folder}/old")
    skewed(spark, "2025-01-02").where("v < 45000").write.parquet(f"{folder}/new")
    old, new = (spark.read.parquet(f"{folder}/{name}") for name in ("old", "new"))
    updated = update_by_key(old, new, ["k"], "date")
    assert len(updated.collect()) == 45_000 + 30_000
    plan = executed(updated)
    assert "SortMergeJoin(skew=true)" in plan
    final = plan[: plan.index("Initial Plan")]
    assert final.count("Exchange hashpartitioning") == 3, "old rows, and the new keys twice"
