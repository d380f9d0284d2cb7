import json

import pytest
from pyspark.sql import functions as F

from murmur.schemas import CHAN_FIELDS, COMMENT_FIELDS, POST_FIELDS
from murmur.session import scratch_path
from murmur.sources import payloads, sinks, tables


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_typed_json_fields(spark):
    data = json.dumps(
        {"author": "ann", "score": 3, "ups": "x", "created": 5.5, "created_utc": 1730419200.0}
    )
    frame = spark.createDataFrame([(data,), ("nope",), (None,)], "data string")
    got = tables.expose_json_fields(frame, POST_FIELDS).collect()
    assert (got[0].author, got[0].votes, got[0].ups) == ("ann", 3, None)
    assert got[0].created == 1730419200
    assert got[1].author is None and got[2].created is None
    chan = spark.createDataFrame([('{"time": 7, "replies": "2", "resto": 0}',)], "data string")
    assert tuple(tables.expose_json_fields(chan, CHAN_FIELDS).collect()[0])[1:] == (7, 2, 0)
    reply = spark.createDataFrame([('{"parent_id": "t1_x", "created": "9.9"}',)], "data string")
    got = tables.expose_json_fields(reply, COMMENT_FIELDS).collect()[0]
    assert (got.reply_to, got.created) == ("t1_x", 9)


def test_load_prunes_the_json(spark, tmp_path):
    path = str(tmp_path / "posts")
    spark.createDataFrame([("1", "s", '{"score": 4}')], "post_id string, subreddit string, data string").write.parquet(path)
    loaded = tables.load_posts_table(spark, path, POST_FIELDS)
    assert loaded.collect()[0].votes == 4
    plan = loaded.select("post_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<post_id:string>" in plan
    raw = str(tmp_path / "json")
    loaded.select("post_id", "data").write.json(raw)
    again = tables.load_posts_table(spark, raw, POST_FIELDS, "json", "post_id string, data string")
    assert again.collect()[0].votes == 4


def test_export_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "e.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('post_id,subreddit,data,cleaned_title\n1,s,"{""created"": 5, ""t"": ""a\nb""}",x\n2,s,{},\n')
    got = tables.load_export_csv(
        spark, path, "post_id string, subreddit string, data string, cleaned_title string",
        ["post_id", "data", "cleaned_title"],
    ).orderBy("post_id").collect()
    assert tuple(got[0]) == ("1", '{"created": 5, "t": "a\nb"}', "x")
    assert got[1].cleaned_title is None


def test_thread_payload(spark):
    payload = json.dumps(
        {"posts": [{"no": 1, "time": 10, "com": "a<br>b", "resto": 0}, {"no": 2, "time": 11}]}
    )
    frame = spark.createDataFrame([("g", 1, payload), ("g", 2, "bad")], "board string, thread_number long, payload string")
    got = payloads.explode_thread_posts(frame, ["board", "thread_number"]).orderBy("post_number").collect()
    assert [(r.post_number, r.created_at, r.com, r.cleaned_text) for r in got] == [
        (1, 10, "a<br>b", "ab"),
        (2, 11, "", ""),
    ]
    assert json.loads(got[0].data)["resto"] == 0


def test_catalog_payload(spark):
    payload = '[{"page":1,"threads":[{"no":5,"sub":"x"},{"no":6}]},{"page":2,"threads":[]}]'
    frame = spark.createDataFrame([("g", payload)], "board string, payload string")
    assert rows(payloads.explode_catalog_threads(frame, ["board"])) == [("g", 5), ("g", 6)]


def test_listing_splits_comments_and_named_ids(spark):
    payload = json.dumps(
        {
            "data": {
                "children": [
                    {"kind": "t1", "data": {"id": "a", "replies": ""}},
                    {"kind": "more", "data": {"children": ["x", "y", "x"]}},
                    {"kind": "t1", "data": {"id": "b"}},
                ],
                "after": None,
            }
        }
    )
    frame = spark.createDataFrame([("p", payload)], "post_id string, payload string")
    got = payloads.explode_listing(frame, ["post_id"]).orderBy("pos").collect()
    assert [(r.pos, r.id) for r in got] == [(0, "a"), (2, "b")]
    assert rows(payloads.listing_more_ids(frame, ["post_id"])) == [("p", "x"), ("p", "y")]


KEYS = ["board", "thread_number", "post_number"]
CHAN = "board string, thread_number int, post_number int, at int, com string"


def test_append_new_posts(spark, tmp_path):
    stored = spark.createDataFrame([("g", 1, 1, 5, "old")], CHAN)
    incoming = spark.createDataFrame(
        [("g", 1, 1, 9, "again"), ("g", 1, 2, 7, "late"), ("g", 1, 2, 6, "first"), ("g", 2, 2, 7, "other")],
        CHAN,
    )
    new = sinks.append_new_posts(stored, incoming, KEYS, "at")
    assert rows(new) == [("g", 1, 2, 6, "first"), ("g", 2, 2, 7, "other")]
    path = str(tmp_path / "chan")
    sinks.write_posts(stored, path)
    sinks.write_posts(new, path)
    held = spark.read.parquet(path).select(*stored.columns)
    assert held.count() == 3
    assert sinks.append_new_posts(held, incoming, KEYS, "at").count() == 0


def test_upsert_latest_twice_is_once(spark):
    target = spark.createDataFrame([("a", "1", 5), ("b", "1", 5)], "id string, data string, v int")
    updates = spark.createDataFrame(
        [("a", "2", 5), ("a", "0", 4), ("c", "9", 1), ("b", "0", 1)], target.schema
    )
    once = sinks.upsert_latest(target, updates, ["id"], "v")
    assert rows(once) == [("a", "2", 5), ("b", "1", 5), ("c", "9", 1)]
    assert rows(sinks.upsert_latest(once, updates, ["id"], "v")) == rows(once)


def test_upsert_partial_keeps_the_first_score(spark):
    schema = "id string, data string, score double, v int"
    target = spark.createDataFrame([("a", "old", 0.1, 0), ("z", "kept", 0.5, 0)], schema)
    updates = spark.createDataFrame(
        [("a", "new", 0.9, 1), ("a", "newest", 0.8, 2), ("n", "second", 0.7, 2), ("n", "first", 0.6, 1)],
        schema,
    )
    args = (["id"], ["data"], ["score"], "v")
    once = sinks.upsert_partial(target, updates, *args)
    assert rows(once) == [("a", "newest", 0.1), ("n", "second", 0.6), ("z", "kept", 0.5)]
    again = sinks.upsert_partial(once, updates, *args)
    assert rows(again) == rows(once)


def test_upsert_partial_keeps_a_first_null(spark):
    schema = "id string, data string, score double, v int"
    target = spark.createDataFrame([("a", "old", None, 0)], schema)
    updates = spark.createDataFrame([("a", "new", 0.9, 1)], schema)
    assert rows(sinks.upsert_partial(target, updates, ["id"], ["data"], ["score"], "v")) == [
        ("a", "new", None)
    ]


def test_daily_metrics_csv_has_a_header(spark, tmp_path):
    path = str(tmp_path / "m")
    sinks.write_daily_metrics(spark.range(3).select(F.col("id").alias("n")), path, "csv")
    assert sorted(r.n for r in spark.read.option("header", True).csv(path).collect()) == ["0", "1", "2"]
    sinks.write_daily_metrics(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "b")
    assert sinks.read_batches(spark, path, "id bigint").count() == 0
    sinks.write_batch(spark.range(3), path, "s", 0)
    sinks.write_batch(spark.range(2), path, "s", 1)
    sinks.write_batch(spark.range(2), path, "s", 1)
    assert sinks.read_batches(spark, path, "id bigint").count() == 5
    assert sinks.read_batches(spark, path, "id bigint", ("s", 1)).count() == 3
    # batch ids of another stream are other batches
    sinks.write_batch(spark.range(7), path, "t", 1)
    assert sinks.read_batches(spark, path, "id bigint").count() == 12
    assert sinks.read_batches(spark, path, "id bigint", ("s", 1)).count() == 10
    assert sinks.read_batch(spark, path, "id bigint", "s", 1).count() == 2
    assert sinks.read_batch(spark, path, "id bigint", "s", 9).count() == 0


def test_scratch_follows_the_checkpoint_setting(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")

    class Named:
        class conf:
            get = staticmethod(lambda key, default=None: "/shared/ckpt/")

    assert scratch_path(Named, "x").startswith("/shared/ckpt/murmur/x-")


def test_local_scratch_is_refused_on_a_cluster():
    from murmur.session import check_local

    for master in ("local", "local[8]", "local[*]"):
        check_local(master)
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,512]", "k8s://x"):
        with pytest.raises(ValueError):
            check_local(master)
