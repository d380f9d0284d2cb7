import json
import os
import time

import pytest
from pyspark.sql import functions as F

from murmur.operators.engagement import hourly_counts
from murmur.streaming import ingest


def drop(folder, name, *records):
    """Write one payload file and keep file times apart, as a crawler would."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))
    time.sleep(0.05)


def thread(board, number, *posts):
    body = {"posts": [{"no": n, "time": t, **({"com": c} if c else {})} for n, t, c in posts]}
    return {"board": board, "thread_number": number, "payload": json.dumps(body)}


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_posts_arrive_once_across_files_and_restarts(spark, tmp_path):
    inbox = tmp_path / "in"
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    drop(inbox, "1.json", thread("g", 1, (1, 10, "a<br>b"), (2, 11, None)))
    drop(inbox, "2.json", thread("g", 1, (1, 10, "a<br>b"), (3, 12, "x")))

    def run():
        ingest.stream_ingest_posts(spark, str(inbox), out, check, per_batch=1).awaitTermination()
        return rows(spark.read.parquet(out).select("board", "post_number", "cleaned_text"))

    first = [("g", 1, "ab"), ("g", 2, ""), ("g", 3, "x")]
    assert run() == first
    # an old post in a new file is not late
    drop(inbox, "3.json", thread("g", 1, (2, 11, None)), thread("pol", 5, (2, 1, "old")))
    assert run() == sorted(first + [("pol", 2, "old")])


def comment(cid, body, *replies, **more):
    node = {"id": cid, "body": body, **more}
    node["replies"] = (
        {"data": {"children": [{"kind": "t1", "data": r} for r in replies]}} if replies else ""
    )
    return node


def listing(post, at, *comments, kind="t1"):
    body = {"data": {"children": [{"kind": kind, "data": c} for c in comments], "after": None}}
    return {"subreddit": "s", "post_id": post, "fetched_at": at, "payload": json.dumps(body)}


def test_comments_keep_the_first_text_and_the_last_data(spark, tmp_path):
    inbox = tmp_path / "in"
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    reply = comment("b", "reply", parent_id="t1_a")
    drop(inbox, "1.json", listing("p", 1, comment("a", "one &amp; only", reply)))
    drop(inbox, "2.json", listing("p", 2, comment("a", "[removed]"), comment("c", "new")))
    ingest.stream_upsert(spark, str(inbox), out, check, per_batch=1).awaitTermination()
    got = {r.id: r for r in ingest.read_comments(spark, out).collect()}
    assert {k: (r.parent_id, r.cleaned_text) for k, r in got.items()} == {
        "a": ("p", "one & only"),
        "b": ("t1_a", "reply"),
        "c": ("p", "new"),
    }
    assert json.loads(got["a"].data)["body"] == "[removed]"


def test_posts_take_the_last_version(spark, tmp_path):
    inbox = tmp_path / "in"
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    post = lambda score: {"id": "x", "author": "ann", "score": score, "created": 5.5}
    drop(inbox, "1.json", listing(None, 2, post(9), kind="t3"))
    drop(inbox, "2.json", listing(None, 1, post(1), kind="t3"))
    ingest.stream_upsert_posts(spark, str(inbox), out, check, per_batch=1).awaitTermination()
    got = ingest.read_posts(spark, out).collect()
    assert [(r.post_id, r.votes, r.created) for r in got] == [("x", 9, 5)]


def catalog(board, at, *threads):
    pages = [{"page": 1, "threads": [{"no": n} for n in threads]}]
    return {"board": board, "snapshot_at": at, "payload": json.dumps(pages)}


@pytest.mark.parametrize("per_batch", [1, None])
def test_dead_threads_across_batches(spark, tmp_path, per_batch):
    inbox = tmp_path / "in"
    out, state, check = (str(tmp_path / n) for n in ("out", "state", "check"))
    drop(inbox, "1.json", catalog("g", 1, 1, 2, 3), catalog("pol", 1, 1))
    drop(inbox, "2.json", catalog("g", 2, 2, 4))
    drop(inbox, "3.json", catalog("g", 3), catalog("pol", 3, 1, 9))
    ingest.stream_dead_threads(
        spark, str(inbox), out, state, check, per_batch=per_batch
    ).awaitTermination()
    got = rows(ingest.read_dead_threads(spark, out, state))
    assert got == [("g", 2, 1), ("g", 2, 3), ("g", 3, 2), ("g", 3, 4)]


def test_new_comments_follow_the_marker(spark, tmp_path):
    inbox = tmp_path / "in"
    out, state, check = (str(tmp_path / n) for n in ("out", "state", "check"))
    c = lambda i: comment(i, i)
    drop(inbox, "1.json", listing("p", 1, c("c2"), c("c1")), listing("q", 1, c("z")))
    drop(inbox, "2.json", listing("p", 2, c("c4"), c("c3"), c("c2"), c("c1")))
    drop(inbox, "3.json", listing("p", 3, c("c4"), c("c3")), listing("q", 3, c("y"), c("z")))
    ingest.stream_new_comments(
        spark, str(inbox), out, state, check, per_batch=1
    ).awaitTermination()
    stored = spark.read.parquet(out).groupBy("post_id", "id").count()
    assert rows(stored) == [
        ("p", "c1", 1), ("p", "c2", 1), ("p", "c3", 1), ("p", "c4", 1), ("q", "y", 1), ("q", "z", 1),
    ]
    held = ingest.read_batches(spark, state, ingest.MARKER_ROWS)
    assert rows(ingest.current_markers(held)) == [("p", "c4"), ("q", "y")]


@pytest.mark.parametrize("lateness", [None, "40 days"])
def test_hourly_counts_equal_the_batch(spark, tmp_path, lateness):
    src = str(tmp_path / "src")
    n = F.col("id")
    frame = spark.range(500).select(
        F.timestamp_seconds(F.lit(1704067200) + n * 7919 % 500000).cast("timestamp_ntz").alias("ts"),
        F.when(n % 3 == 0, "g").otherwise("pol").alias("board"),
    )
    frame.repartition(6).write.parquet(src)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 2).parquet(src)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    ingest.stream_hourly_counts(stream, out, check, lateness=lateness).awaitTermination()
    got = ingest.read_hourly_counts(spark, out)
    batch = frame.withColumn("created", F.unix_timestamp(F.col("ts").cast("timestamp")))
    expected = {
        (b, r.hour, r.post_count)
        for b in ("g", "pol")
        for r in hourly_counts(batch.where(F.col("board") == b)).collect()
    }
    assert {tuple(r) for r in got.select("board", "hour", "post_count").collect()} == expected


def test_late_files_and_second_streams_add(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")

    def run(name):
        ingest.stream_ingest_posts(spark, str(inbox), out, str(tmp_path / name), per_batch=1).awaitTermination()
        return rows(spark.read.parquet(out).select("board", "post_number"))

    drop(inbox, "1.json", thread("g", 1, (1, 10, "a")))
    assert run("one") == [("g", 1)]
    drop(inbox, "2.json", thread("g", 1, (2, 5, "late")), {"board": "g", "thread_number": 3, "payload": "nope"})
    old = time.time() - 10 * 86400
    os.utime(inbox / "2.json", (old, old))
    assert run("one") == [("g", 1), ("g", 2)]
    broken = spark.read.parquet(f"{out}_unreadable")
    assert [r.payload for r in broken.collect()] == ["nope"]
    # a new checkpoint reads everything again and stores nothing twice
    drop(inbox, "3.json", thread("g", 1, (3, 12, "new")))
    assert run("two") == [("g", 1), ("g", 2), ("g", 3)]


def test_keyed_tables_of_two_streams_add(spark, tmp_path):
    out = str(tmp_path / "out")
    for name, text in (("x", "one"), ("y", "two")):
        drop(tmp_path / name, "1.json", listing("p", 1, comment(name, text)))
        ingest.stream_upsert(spark, str(tmp_path / name), out, str(tmp_path / f"c{name}")).awaitTermination()
    assert sorted(r.id for r in ingest.read_comments(spark, out).collect()) == ["x", "y"]


def test_trees_too_deep_are_kept_beside_the_table(spark, tmp_path):
    deep = comment("d240", "leaf")
    for n in range(239, -1, -1):
        deep = comment(f"d{n}", "x", deep)
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    drop(inbox, "1.json", listing("p", 1, comment("a", "flat")), listing("q", 1, deep))
    ingest.stream_upsert(spark, str(inbox), out, str(tmp_path / "c")).awaitTermination()
    assert [r.id for r in ingest.read_comments(spark, out).collect()] == ["a"]
    assert [r.post_id for r in spark.read.parquet(f"{out}_unreadable").collect()] == ["q"]


def test_a_snapshot_may_span_batches(spark, tmp_path):
    inbox = tmp_path / "in"
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    drop(inbox, "1.json", catalog("g", 1, 1, 2, 3))
    drop(inbox, "2.json", catalog("g", 2, 2))
    drop(inbox, "3.json", catalog("g", 2, 3))
    drop(inbox, "4.json", {"board": "g", "snapshot_at": 3, "payload": "broken"})

    def run(name):
        ingest.stream_dead_threads(spark, str(inbox), out, state, str(tmp_path / name), per_batch=1).awaitTermination()
        return rows(ingest.read_dead_threads(spark, out, state))

    assert run("one") == [("g", 2, 1)]
    # another stream goes on from the stored snapshots
    inbox = tmp_path / "in2"
    drop(inbox, "5.json", catalog("g", 4, 3))
    assert run("two") == [("g", 2, 1), ("g", 4, 2)]


def snapshots_in_order(spark, records):
    frame = spark.createDataFrame(
        [(r["board"], r["snapshot_at"], r["payload"]) for r in records],
        "board string, snapshot_at long, payload string",
    )
    return rows(ingest.dead_between_snapshots(frame))


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (1, 3, 0, 2), (2, 0, 3, 1)])
def test_snapshots_in_any_order(spark, tmp_path, order):
    files = [
        [catalog("g", 10, 1, 2, 3), catalog("pol", 10, 1)],
        [catalog("g", 20, 2, 3, 4)],
        [catalog("g", 30, 2), catalog("g", 20, 5), catalog("pol", 25)],  # a further piece of g at 20
        [catalog("g", 40), catalog("pol", 30, 7, 8)],
    ]
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for at, k in enumerate(order):
        drop(inbox, f"{at}.json", *files[k])
    ingest.stream_dead_threads(
        spark, str(inbox), out, state, str(tmp_path / "c"), per_batch=1, compact_every=2
    ).awaitTermination()
    want = snapshots_in_order(spark, [r for f in files for r in f])
    assert want == [("g", 20, 1), ("g", 30, 3), ("g", 30, 4), ("g", 30, 5), ("g", 40, 2), ("pol", 25, 1)]
    assert rows(ingest.read_dead_threads(spark, out)) == want


def test_snapshots_past_the_lateness_are_kept_beside_the_table(spark, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    times = [100, 200, 190, 300, 120, 260]
    for k, at in enumerate(times):
        drop(inbox, f"{k}.json", catalog("g", at, *range(at, at + 3)))
    ingest.stream_dead_threads(
        spark, str(inbox), out, state, str(tmp_path / "c"), per_batch=1, lateness=50, compact_every=1
    ).awaitTermination()
    late = spark.read.json(str(inbox)).where("snapshot_at = 120").count()
    assert late == 1 and [r.snapshot_at for r in spark.read.parquet(f"{out}_late").collect()] == [120]
    in_time = [catalog("g", at, *range(at, at + 3)) for at in times if at != 120]
    assert rows(ingest.read_dead_threads(spark, out)) == snapshots_in_order(spark, in_time)
    # the base holds what may still be a neighbour
    table = ingest.snapshots_table(state, 50)
    base = ingest.keyed.read_base(spark, table, ingest.keyed.pointer(spark, table))
    assert sorted(r.snapshot_at for r in base.select("snapshot_at").distinct().collect()) == [200, 300]


def test_unreadable_listings_of_new_comments_are_kept(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    drop(inbox, "1.json", listing("p", 1, comment("a", "x")), {"subreddit": "s", "post_id": "q", "fetched_at": 1, "payload": "{"})
    ingest.stream_new_comments(spark, str(inbox), out, str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    assert [r.id for r in spark.read.parquet(out).collect()] == ["a"]
    assert [r.post_id for r in spark.read.parquet(f"{out}_unreadable").collect()] == ["q"]
