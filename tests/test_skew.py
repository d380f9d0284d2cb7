"""Hot keys: a third of all rows on one key must give the same rows as a plain join."""

import pytest
from pyspark.sql import functions as F

from murmur.operators import joins, network
from murmur.operators.nested import new_comments_since
from murmur.operators.ranking import cap_rows_per_group
from murmur.operators.skew import hot_keys, salted_join, top_n_per_group


@pytest.fixture(scope="module")
def facts(spark):
    """3000 rows; a third on key 0, some without a key or a partner."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 0).when(n % 100 == 1, None).otherwise(n % 50)
    return spark.range(3000).select(key.alias("k"), n.alias("v"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(45).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_hot_keys_are_few_and_split_by_size(facts):
    found = {r.k: r._parts for r in hot_keys(facts, ["k"], 200).collect()}
    assert found[0] >= 5 and len(found) <= 3000 // 200


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("rows_per_task", [10, 200, 10**6])
def test_salted_join_equals_plain_join(facts, dim, how, rows_per_task):
    salted = salted_join(facts, dim, ["k"], how, rows_per_task)
    plain = facts.join(dim, ["k"], how)
    assert rows(salted.select(plain.columns)) == rows(plain)


def test_salted_join_spreads_the_hot_key(spark, facts, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        joined = salted_join(facts, dim, ["k"], "inner", 50)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 4)


@pytest.mark.parametrize("parts", [1, 8])
def test_top_n_per_group(facts, parts):
    got = top_n_per_group(
        facts.where("k is not null"), ["k"], [F.col("v").desc()], 3, parts, rank="r"
    )
    expected = {}
    for r in facts.where("k is not null").orderBy(F.col("v").desc()).collect():
        expected.setdefault(r.k, []).append(r.v)
    wanted = sorted((k, v, i + 1) for k, vs in expected.items() for i, v in enumerate(vs[:3]))
    assert sorted(map(tuple, got.collect())) == wanted


def test_cap_keeps_the_first_in_arrival_order(spark):
    frame = spark.createDataFrame(
        [("p", i, f"c{i}") for i in range(20)] + [("q", 0, "d")], "post_id string, pos int, id string"
    )
    got = cap_rows_per_group(frame, ["post_id"], [F.col("pos").asc()], 5)
    assert sorted(r.id for r in got.collect()) == ["c0", "c1", "c2", "c3", "c4", "d"]


@pytest.fixture(scope="module")
def forum(spark):
    """One post holds a third of the comments; some authors are bots or missing."""
    posts = spark.range(40).select(
        F.col("id").cast("string").alias("post_id"),
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("subreddit"),
        F.when(F.col("id") == 7, "AutoModerator")
        .otherwise(F.concat(F.lit("u"), (F.col("id") % 9).cast("string")))
        .alias("author"),
        F.col("id").cast("int").alias("votes"),
    )
    n = F.col("id")
    comments = spark.range(1500).select(
        n.cast("string").alias("id"),
        F.when(n % 3 == 0, 0).otherwise(n % 45).cast("string").alias("post_id"),
        F.when(n % 17 == 0, None)
        .when(n % 19 == 0, "[deleted]")
        .otherwise(F.concat(F.lit("u"), (n % 11).cast("string")))
        .alias("author"),
        ((n % 64) / 64).alias("mod_score"),
    )
    return posts, comments


@pytest.mark.parametrize("rows_per_task", [20, 10**6])
def test_interactions_raw_and_merged_agree(forum, rows_per_task):
    posts, comments = forum
    raw = joins.post_comment_interactions(posts, comments, rows_per_task=rows_per_task).cache()
    merged = joins.interaction_counts(posts, comments, rows_per_task=rows_per_task).cache()
    kept = [
        (p, c)
        for p in posts.collect()
        for c in comments.collect()
        if p.post_id == c.post_id
        and p.author != "AutoModerator"
        and c.author not in (None, "[deleted]")
    ]
    assert raw.count() == len(kept) == merged.agg(F.sum("n")).collect()[0][0]
    for build in (
        network.post_author_stats,
        network.comment_author_stats,
        network.user_activity,
        network.interaction_edges,
        network.subreddit_network_overview,
        network.subreddit_interaction_network,
        lambda i: network.post_author_stats(i, ["subreddit"], distinct_posts=True),
    ):
        assert rows(build(raw)) == rows(build(merged))


@pytest.mark.parametrize("rows_per_task", [20, 10**6])
def test_comments_of_topic(forum, rows_per_task):
    posts, comments = forum
    topic = posts.where("subreddit = 's0'")
    got = joins.comments_of_topic(comments, topic, rows_per_task)
    assert rows(got.select("id")) == rows(
        comments.join(topic.select("post_id"), "post_id", "left_semi").select("id")
    )


@pytest.mark.parametrize("rows_per_task", [5, 10**6])
def test_new_comments_since(spark, rows_per_task):
    comments = spark.createDataFrame(
        [("a", f"c{i}", 50 - i) for i in range(50)]
        + [("b", "x", 0), ("b", "y", 1), ("c", "z", 0), ("d", "n1", 0), ("d", "n2", 1)],
        "post_id string, id string, pos int",
    )
    state = spark.createDataFrame(
        [("a", "c10"), ("b", "x"), ("c", None), ("d", "gone")],
        "post_id string, last_comment_id string",
    )
    got = new_comments_since(comments, state, rows_per_task)
    expected = [f"c{i}" for i in range(11, 50)] + ["z", "n1", "n2"]
    assert sorted(r.id for r in got.collect()) == sorted(expected)
