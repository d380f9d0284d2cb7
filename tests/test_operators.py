import datetime as dt
from datetime import date

import pytest
from pyspark.sql import functions as F

from murmur.operators import engagement, filters, joins, network, ranking, series, topics
from murmur.operators.nested import (
    flatten_comment_tree,
    new_comments_since,
    next_markers,
    unreadable_payloads,
)


def epoch(*parts):
    return int(dt.datetime(*parts, tzinfo=dt.timezone.utc).timestamp())


# --- filters -----------------------------------------------------------------------


def test_exclude_bots_drops_missing_authors(spark):
    frame = spark.createDataFrame(
        [("ann",), (None,), ("[deleted]",), ("AutoModerator",), ("null",)], "author string"
    )
    assert [r.author for r in filters.exclude_bots(frame, ["author"]).collect()] == ["ann"]


def test_match_any_phrase(spark):
    rows = [
        ("Deep Learning now", None),
        (None, "about AI tools"),
        ("the end of AI", None),
        ("Dubai trip", ""),
        (None, None),
    ]
    frame = spark.createDataFrame(rows, "title string, text string")
    got = filters.match_any_phrase(frame, ["title", "text"]).collect()
    assert [tuple(r) for r in got] == [rows[0], rows[1], rows[3]]


def test_date_filter_includes_the_whole_last_day(spark):
    frame = spark.createDataFrame(
        [(epoch(2024, 10, 31, 23, 59, 59),), (epoch(2024, 11, 1),), (epoch(2024, 11, 14, 23, 59),),
         (epoch(2024, 11, 15),)],
        "created bigint",
    )
    got = filters.filter_date_between(frame, date(2024, 11, 1), date(2024, 11, 14))
    assert [r.created for r in got.collect()] == [epoch(2024, 11, 1), epoch(2024, 11, 14, 23, 59)]


def test_epoch_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.col("id").alias("created"), F.lit("x").alias("y")).write.parquet(path)
    plan = filters.filter_epoch_between(spark.read.parquet(path).select("created"), 3, 9)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created,3)" in text and "struct<created:bigint>" in text
    assert plan.count() == 7


def test_stale_posts(spark):
    now = epoch(2024, 11, 14)
    frame = spark.createDataFrame(
        [
            ("never", "s", now - 100, None),
            ("old", "s", now - 8 * 86400, None),
            ("fresh", "s", now - 100, now - 3600),
            ("due", "s", now - 50, now - 7 * 3600),
            ("else", "t", now - 100, None),
        ],
        "post_id string, subreddit string, created bigint, last_comment_update bigint",
    )
    assert [r.post_id for r in filters.stale_posts(frame, "s", now).collect()] == ["due", "never"]


def test_topics_apply_to_each_source(spark):
    posts = spark.createDataFrame(
        [("1", "politics"), ("2", "OpenAI")], "post_id string, subreddit string"
    )
    comments = spark.createDataFrame([("c", "1"), ("d", "2")], "id string, post_id string")
    chan = spark.createDataFrame(
        [("g", "AI is here"), ("g", "other"), ("pol", "AI is here"), ("g", None)],
        "board string, cleaned_text string",
    )
    assert topics.topic_filter(posts, "AI", "posts").collect()[0].post_id == "2"
    assert topics.topic_filter(comments, "Politics", "comments", posts).collect()[0].id == "c"
    assert [tuple(r) for r in topics.topic_filter(chan, "AI", "chan_posts").collect()] == [
        ("g", "AI is here")
    ]
    assert topics.topic_filter(chan, "Politics", "chan_posts").count() == 1


# --- engagement ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def forum(spark):
    posts = spark.createDataFrame(
        [
            ("p1", "s", "ann", 10, epoch(2024, 11, 1, 5, 10), "ai news", None),
            ("p2", "s", "ann", 20, epoch(2024, 11, 1, 5, 50), "ai more", None),
            ("p3", "t", "bob", 5, epoch(2024, 11, 2, 6), "other", "deep learning"),
            ("p4", "t", None, 5, epoch(2024, 11, 2, 6), "ai x", None),
        ],
        "post_id string, subreddit string, author string, votes int, created bigint, "
        "cleaned_title string, cleaned_text string",
    )
    comments = spark.createDataFrame(
        [("c1", "p1", "bob", 0.5), ("c2", "p1", "cat", 0.25), ("c3", "p1", "bob", None),
         ("c4", "p3", "ann", 1.0), ("c5", "zz", "ann", 1.0)],
        "id string, post_id string, author string, mod_score double",
    )
    return posts, comments


def test_hourly_engagement(forum):
    got = engagement.hourly_engagement(*forum, 0, 2**40).orderBy("hour").collect()
    assert [tuple(r) for r in got] == [
        (dt.datetime(2024, 11, 1, 5), "s", 2, 3, 0.375),
        (dt.datetime(2024, 11, 2, 6), "t", 2, 1, 1.0),
    ]


def test_hour_without_comments_scores_zero(forum):
    posts, comments = forum
    got = engagement.hourly_engagement(posts, comments.limit(0), 0, 2**40).collect()
    assert {(r.comment_count, r.avg_comment_score) for r in got} == {(0, 0.0)}


def test_ai_user_engagement(forum):
    got = engagement.ai_user_engagement(*forum, 0, 2**40).orderBy("author").collect()
    assert [tuple(r) for r in got] == [
        ("ann", "s", 2, 30, 3, 0.75, 30.75),
        ("bob", "t", 1, 5, 1, 1.0, 6.0),
    ]


def test_engagement_summary_first_peak_wins(spark):
    hours = spark.createDataFrame(
        [(1, 5.0, 1.0), (3, 5.0, 2.0)], "hour int, post_count double, comment_count double"
    )
    days = spark.createDataFrame(
        [(0, "Monday", 2.0, 9.0), (6, "Sunday", 2.0, 9.0)],
        "day_order int, day string, post_count double, comment_count double",
    )
    got = engagement.engagement_summary(hours, days, ("post_count", "comment_count")).collect()[0]
    assert got.peak_hour_post_count == 1 and got.peak_hour_comment_count == 3
    assert got.peak_day_post_count == "Monday" and got.avg_hour_comment_count == 1.5
    assert got.avg_day_post_count == 2.0


def test_daily_upvotes_defaults(spark):
    frame = spark.createDataFrame(
        [('{"ups": 4}', epoch(2024, 11, 1)), ("{}", epoch(2024, 11, 1)), ('{"ups": "x"}', epoch(2024, 11, 1)),
         ('{"ups": 9}', None)],
        "data string, created bigint",
    )
    got = engagement.daily_avg_upvotes(frame).collect()
    assert [(r.date, round(r.avg_ups, 6)) for r in got] == [(date(2024, 11, 1), 1.333333)]


def test_pivot_sums_to_the_counts(spark):
    chan = spark.createDataFrame(
        [(0, epoch(2024, 1, 1, h % 24, 5) + 86400 * (h % 3)) for h in range(100)] + [(9, 0)],
        "resto int, created bigint",
    )
    counts = engagement.date_hour_counts(chan)
    profile = engagement.root_hour_profile(counts)
    by_hour = {}
    for r in counts.collect():
        by_hour.setdefault(r.hour, []).append(r.post_count)
    assert {r.hour: r.post_count for r in profile.collect()} == {
        h: sum(v) / len(v) for h, v in by_hour.items()
    }
    pivot = engagement.date_hour_pivot(counts)
    assert pivot.columns == ["date"] + [f"h{h:02d}" for h in range(24)]
    assert sum(sum(r[1:]) for r in pivot.collect()) == 100


def test_toxicity(spark):
    day = epoch(2024, 11, 1)
    frame = spark.createDataFrame(
        [(day, "flag", 0.5), (day, "flag", 1.0), (day, "normal", 0.9), (day + 86400, "normal", 0.1)],
        "created bigint, class string, mod_score double",
    )
    daily = engagement.daily_toxicity(frame)
    assert [tuple(r)[1:] for r in daily.orderBy("date").collect()] == [(3, 0.75, 2), (1, None, 0)]
    summary = engagement.toxicity_summary(daily).collect()[0]
    assert tuple(summary) == (0.75, 0.75, 2, 50.0)


def test_records_with_terms(spark):
    frame = spark.createDataFrame([("gpt gpt",), ("none",), ("",), (None,)], "t string")
    assert tuple(engagement.records_with_terms(frame, "t").collect()[0]) == (1, 50.0)
    assert [tuple(r) for r in engagement.term_counts(frame, "t").collect()] == [("gpt", 2)]


# --- series ------------------------------------------------------------------------------


def test_grids(spark):
    counts = spark.createDataFrame(
        [(dt.datetime(2024, 11, 3, 4), 7)], "hour timestamp_ntz, post_count bigint"
    )
    filled = joins.gap_fill_hours(counts, date(2024, 11, 1), date(2024, 11, 14)).collect()
    assert len(filled) == 337 and sum(r.post_count for r in filled) == 7
    assert filled[-1].hour == dt.datetime(2024, 11, 15)
    days = spark.createDataFrame([(date(2024, 11, 3), 7)], "date date, post_count bigint")
    filled = joins.gap_fill_days(days, date(2024, 11, 1), date(2024, 11, 14)).collect()
    assert len(filled) == 14 and sum(r.post_count for r in filled) == 7


def test_peak_row_first_wins(spark):
    frame = spark.createDataFrame([(3, 5), (1, 5), (2, None)], "hour int, n int")
    assert tuple(series.peak_row(frame, "n", "hour").collect()[0]) == (1, 5)


def daily(spark, values):
    first = date(2024, 11, 1)
    return spark.createDataFrame(
        [(first + dt.timedelta(days=i), v) for i, v in enumerate(values)],
        f"date date, v {'double' if isinstance(values[0], float) else 'bigint'}",
    )


def test_trend(spark):
    got = series.trend_first_last(daily(spark, list(range(1, 11))), "v", "date").collect()
    assert [tuple(r) for r in got] == [(7, 4.0, 7.0, 75.0)]
    got = series.trend_first_last(daily(spark, [2, 4]), "v", "date").collect()
    assert [tuple(r) for r in got] == [(2, 3.0, 3.0, 0.0)]
    assert series.trend_first_last(daily(spark, [2]), "v", "date").count() == 0


def test_cumulative_sentiment_is_exact(spark):
    frame = daily(spark, [0.1, 0.2, 0.0, -0.05]).withColumnRenamed("v", "avg_sentiment")
    got = series.cumulative_sentiment(frame).orderBy("date").collect()
    assert [r.cumulative_sentiment for r in got] == [0.1, 0.3, 0.3, 0.25]


def test_daily_sentiment_fills_empty_days(spark):
    frame = spark.createDataFrame(
        [(1, epoch(2024, 11, 1), "good"), (2, epoch(2024, 11, 1), "bad good"), (3, epoch(2024, 11, 3), "x"),
         (4, epoch(2024, 11, 3), None)],
        "id int, created bigint, t string",
    )
    lexicon = {"good": 0.5, "bad": -1.0}
    got = engagement.daily_sentiment(
        frame, ["id"], "t", lexicon, date(2024, 11, 1), date(2024, 11, 3)
    ).collect()
    assert [tuple(r) for r in got] == [
        (date(2024, 11, 1), 0.13, 2),
        (date(2024, 11, 2), 0.0, 0),
        (date(2024, 11, 3), 0.0, 1),
    ]


def test_last_n_rows_counts_rows(spark):
    got = series.last_n_rows(daily(spark, list(range(40))), 30).collect()
    assert [r.v for r in got] == list(range(10, 40))


def test_series_summary(spark):
    got = series.series_summary(daily(spark, [3, 9, 9, 1]), "v", "date").collect()[0]
    assert tuple(got) == (22, 5.5, 9, 1, date(2024, 11, 2))


# --- network ----------------------------------------------------------------------------------


INTERACTIONS = "post_id string, subreddit string, post_author string, post_score int, comment_author string, comment_score double"


def test_edges(spark):
    frame = spark.createDataFrame(
        [("1", "s", "a", 1, "b", 0.5), ("2", "s", "b", 1, "a", 0.5), ("1", "s", "a", 1, "a", 0.5)],
        INTERACTIONS,
    )
    edges = network.interaction_edges(frame)
    assert [tuple(r) for r in edges.collect()] == [("a", "b", 2)]
    assert tuple(network.interaction_summary(edges).collect()[0]) == (2, 2.0)
    assert tuple(network.interaction_summary(edges.limit(0)).collect()[0]) == (0, 0.0)


def test_user_stats_two_ways(spark):
    frame = spark.createDataFrame(
        [("1", "s", "a", 10, "b", 0.5), ("1", "s", "a", 10, "c", None), ("2", "s", "b", 4, "a", 0.25)],
        INTERACTIONS,
    )
    joined = joins.user_stats_outer(
        network.post_author_stats(frame), network.comment_author_stats(frame)
    )
    expected = [("a", 2, 20, 0.25), ("b", 1, 4, 0.5), ("c", 0, 0, 0.0)]
    assert sorted(map(tuple, joined.collect())) == expected
    assert sorted(map(tuple, network.user_activity(frame).collect())) == expected
    once = network.post_author_stats(frame, distinct_posts=True)
    assert sorted(map(tuple, once.collect())) == [("a", 1, 10), ("b", 1, 4)]


def test_equal_scores_give_size_thirty(spark):
    frame = spark.createDataFrame([("1", "s", "a", 0, "a", 0.0)], INTERACTIONS)
    nodes = network.network_nodes(frame).collect()
    assert [(r.user, r.node_size) for r in nodes] == [("a", 30.0)]
    users = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "user string, v double")
    assert {r.user: r.node_size for r in network.scale_min_max(users, "v").collect()} == {
        "a": 20.0, "b": 45.0, "c": 32.5,
    }


def test_network_keeps_top_users_only(spark):
    rows = [(str(i), "s", f"u{i:02d}", i * 10, "u11", 1.0) for i in range(12)]
    both = network.subreddit_interaction_network(
        spark.createDataFrame(rows, INTERACTIONS), n=3, subreddit="s"
    )
    nodes = {r.user_a for r in both.where("kind = 'node'").collect()}
    edges = {(r.user_a, r.user_b) for r in both.where("kind = 'edge'").collect()}
    assert nodes == {"u11", "u10", "u09"}
    assert edges == {("u10", "u11"), ("u09", "u11")}


def test_top_users_per_subreddit(spark):
    users = spark.createDataFrame(
        [(f"a{i}", f"s{i % 3}", float(i % 4)) for i in range(24)],
        "author string, subreddit string, total_engagement_score double",
    )
    got = ranking.top_users_per_subreddit(users, n=2, subreddits=2).collect()
    assert len(got) == 4 and {r["rank"] for r in got} == {1, 2}
    assert len({r.subreddit for r in got}) == 2


def test_concat_frames_fills_missing_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([("t",)], "y string")
    assert [tuple(r) for r in ranking.concat_frames([a, b]).collect()] == [(1, None), (None, "t")]


def test_dead_threads(spark):
    before = spark.createDataFrame([("g", 1), ("g", 2), ("g", 2)], "board string, no int")
    now = spark.createDataFrame([("g", 1), ("g", 3)], "board string, no int")
    assert [tuple(r) for r in joins.dead_threads(before, now, ["board", "no"]).collect()] == [("g", 2)]


# --- nested ---------------------------------------------------------------------------------------


def tree(*levels):
    """Nested comment JSON, one comment per level."""
    import json

    node = ""
    for i in reversed(levels):
        reply = {"data": {"children": [{"kind": "t1", "data": node}]}} if node else ""
        node = {"id": i, "body": f"text {i}", "replies": reply}
    return json.dumps(node)


def flat(spark, *payloads):
    frame = spark.createDataFrame([("p", x) for x in payloads], "post_id string, payload string")
    return flatten_comment_tree(frame).orderBy("position").collect()


def test_empty_replies_are_a_leaf(spark):
    rows = flat(spark, '{"id":"a","body":"x","replies":""}')
    assert [(r.id, r.parent_id, r.comment_text) for r in rows] == [("a", "p", "x")]


@pytest.mark.parametrize("depth", [3, 150])
def test_deep_trees_come_out_whole_and_in_order(spark, depth):
    ids = [f"c{i}" for i in range(depth)]
    rows = flat(spark, tree(*ids))
    assert [r.id for r in rows] == ids


def test_pre_order_and_skipped_children(spark):
    payload = (
        '{"id":"r","body":"x","parent_id":"t3_p","replies":{"data":{"children":['
        '{"kind":"t1","data":{"id":"a","body":"1","parent_id":"r","replies":{"data":{"children":['
        '{"kind":"t1","data":{"id":"b","body":"2","parent_id":"a"}}]}}}},'
        '{"kind":"more","data":{"children":["x","y"]}},'
        '{"kind":"t1","data":{"id":"c","body":"3","parent_id":"r","replies":{}}}]}}}'
    )
    rows = flat(spark, payload)
    assert [(r.id, r.parent_id) for r in rows] == [
        ("r", "t3_p"), ("a", "r"), ("b", "a"), ("c", "r"),
    ]
    assert '"id":"b"' in rows[1].data


def test_unreadable_payloads_are_listed(spark):
    assert flat(spark, "nope") == []
    frame = spark.createDataFrame([("nope",), (tree("a"),), (None,)], "payload string")
    assert [r.payload for r in unreadable_payloads(frame).collect()] == ["nope"]


def test_marker_moves_to_the_first_new_comment(spark):
    comments = spark.createDataFrame(
        [("p", "c3", 0), ("p", "c2", 1), ("p", "c1", 2), ("q", "c1", 0)],
        "post_id string, id string, pos int",
    )
    state = spark.createDataFrame([("p", "c1"), ("q", "c1")], "post_id string, last_comment_id string")
    fresh = new_comments_since(comments, state)
    assert sorted(r.id for r in fresh.collect()) == ["c2", "c3"]
    assert sorted(map(tuple, next_markers(fresh, state).collect())) == [("p", "c3"), ("q", "c1")]
