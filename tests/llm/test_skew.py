"""Joins at a key of most rows are split by adaptive execution, as the docstrings say."""

import pytest

from tidelake.llm import common, line_dedup


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
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_line_is_split(spark, small_skew, large_tables):
    """One line in every document, beside a line of its own."""
    texts = spark.range(0, 60_000, 1, 16).selectExpr(
        "id AS doc_id",
        "concat('a line that stands in every one of the documents here\\n', 'and a line of its own for ', id, ' with some words') AS text",
        "'en' AS lang", "'s' AS source", "id AS n_chars",
    )
    drops = line_dedup.repeated_lines(texts, 5, 40, "doc_id", "text")
    assert "SortMergeJoin(skew=true)" in executed(drops)
    assert drops.count() == 59_999


def test_a_join_with_what_was_aggregated_by_its_key_is_split(spark, small_skew, large_tables):
    rows = spark.range(0, 90_000, 1, 16).selectExpr("IF(id % 3 = 0, -1, id) AS key", "id AS v")
    counts, same = common.null_safe(rows.groupBy("key").count(), "key")
    joined = rows.join(counts, same)
    assert "SortMergeJoin(skew=true)" in executed(joined)
    assert joined.count() == 90_000


def test_null_keys_meet_null(spark):
    left = spark.createDataFrame([(None, 1), (1, 2)], "key INT, v INT")
    right, same = common.null_safe(spark.createDataFrame([(None, 5), (2, 6)], "key INT, w INT"), "key")
    assert [tuple(r) for r in left.join(right, same).select("key", "v", "w").collect()] == [(None, 1, 5)]
