import random

import pytest
from pyspark.sql import functions as F

from murmur.sources import keyed, sinks
from murmur.sources.keyed import Keyed
from murmur.streaming import ingest
from tests.test_streaming import comment, drop, listing, rows, thread

ROWS = "id string, data string, text string, at bigint"


def latest(path, **options):
    return Keyed(path, ROWS, ("id",), lambda r: sinks.latest_rows(r, ["id"], "at"), **options)


def batch(spark, table, stream, number, *lines):
    sinks.write_batch(spark.createDataFrame(list(lines), ROWS), table.path, stream, number)


def test_compaction_changes_no_answer(spark, tmp_path):
    rng = random.Random(4)
    table = latest(str(tmp_path / "t"), bucket_rows=8)
    every = []
    for i in range(9):
        lines = [(f"k{rng.randint(0, 30)}", f"d{i}.{j}", "t", rng.randint(0, 50)) for j in range(12)]
        every += lines
        batch(spark, table, "s" if i % 3 else "r", i, *lines)
        if i in (2, 3, 6):
            keyed.compact(spark, table)
        want = rows(sinks.latest_rows(spark.createDataFrame(every, ROWS), ["id"], "at"))
        assert rows(keyed.read_merged(spark, table)) == want
    at = keyed.pointer(spark, table)
    assert at.version == 3 and at.buckets > 1
    assert keyed.read_since(spark, table, at).select("stream", "batch_id").distinct().count() < 9


def test_first_and_last_survive_compaction(spark, tmp_path):
    columns = (["id"], ["data"], ["text"], "at")
    table = Keyed(str(tmp_path / "t"), ROWS, ("id",), lambda r: sinks.first_and_latest_rows(r, *columns))
    lines = [("a", "2", "second", 5), ("a", "3", "third", 9), ("a", "1", "first", 1), ("b", None, None, 2), ("a", "0", "zero", 0)]
    for i, line in enumerate(lines):
        batch(spark, table, "s", i, line)
        keyed.compact(spark, table)
        stored = keyed.read_rows(spark, table)
        got = sinks.upsert_partial(stored.limit(0), stored, *columns)
        every = spark.createDataFrame(lines[: i + 1], ROWS)
        assert rows(got) == rows(sinks.upsert_partial(every.limit(0), every, *columns))
    assert rows(got) == [("a", "3", "zero"), ("b", None, None)]
    # a key is two rows in the base at most, however many batches it came in
    assert keyed.read_base(spark, table, keyed.pointer(spark, table)).where("id = 'a'").count() == 2


def test_a_compaction_that_ends_early_changes_nothing(spark, tmp_path, monkeypatch):
    table = latest(str(tmp_path / "t"))
    for i in range(3):
        batch(spark, table, "s", i, ("a", str(i), "t", i), (f"b{i}", "x", "t", 1))
    want = rows(keyed.read_merged(spark, table))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(keyed, "write_pointer", lost)
        with pytest.raises(RuntimeError):
            keyed.compact(spark, table)
    assert keyed.pointer(spark, table).version == 0
    assert rows(keyed.read_merged(spark, table)) == want
    keyed.compact(spark, table)
    assert keyed.pointer(spark, table).folded == {"s": 1}
    assert rows(keyed.read_merged(spark, table)) == want
    # what the first try left is named by no pointer
    assert len(keyed.expire(spark, table)) == 1
    assert rows(keyed.read_merged(spark, table)) == want


def test_the_newest_batch_may_be_written_again(spark, tmp_path):
    table = latest(str(tmp_path / "t"))
    batch(spark, table, "s", 0, ("a", "0", "t", 0))
    batch(spark, table, "s", 1, ("a", "1", "t", 1))
    keyed.compact(spark, table)
    batch(spark, table, "s", 1, ("a", "1", "t", 1))
    assert rows(keyed.read_rows(spark, table)) == [("a", "0", "t", 0), ("a", "1", "t", 1)]
    assert keyed.compact(spark, table).version == 1  # nothing older than the newest is left


def test_untouched_buckets_keep_their_folder(spark, tmp_path):
    table = latest(str(tmp_path / "t"))
    batch(spark, table, "s", 0, *((f"k{i}", "0", "t", 0) for i in range(100)))
    batch(spark, table, "s", 1, ("k7", "1", "t", 1))
    first = keyed.compact(spark, table, buckets=16)
    batch(spark, table, "s", 2, ("k7", "2", "t", 2))
    second = keyed.compact(spark, table)
    assert (first.buckets, second.buckets) == (16, 16)
    assert sum(first.folders[b] != second.folders[b] for b in first.folders) == 1
    assert sum(second.rows.values()) == 100
    keyed.expire(spark, table)
    assert rows(keyed.read_merged(spark, table).where("id = 'k7'")) == [("k7", "2", "t", 2)]
    assert keyed.read_merged(spark, table).count() == 100


def test_what_a_batch_reads_does_not_grow(spark, tmp_path):
    """20 batches of 200 new keys; each looks up 5 of them."""
    table = latest(str(tmp_path / "t"), bucket_rows=100)
    read = []
    for i in range(20):
        batch(spark, table, "s", i, *((f"k{i}.{j}", "d", "t", i) for j in range(200)))
        if keyed.due(i, 2):
            keyed.compact(spark, table)
        wanted = spark.createDataFrame([(f"k{i}.{j}",) for j in range(5)], "id string")
        found = keyed.look_up(spark, table, wanted)
        read.append(found.count())
        assert found.join(wanted, "id", "left_semi").count() == 5
    assert keyed.pointer(spark, table).buckets >= 32
    # the batches since the last compaction (3 at most), and 5 buckets
    assert max(read[10:]) <= 3 * 200 + 5 * 100


def test_posts_arrive_once_over_compactions(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    want = []
    for i in range(7):
        posts = [(i * 10 + j, i, f"x{i}") for j in range(3)] + ([(i * 10 - 10, 0, "again")] if i else [])
        drop(inbox, f"{i}.json", thread("g", 1, *posts[:2]), thread("g", i % 2 + 2, *posts[2:]))
        want += [("g", 1, i * 10), ("g", 1, i * 10 + 1)]
    def run(check):
        stream = ingest.stream_ingest_posts(
            spark, str(inbox), out, str(tmp_path / check), per_batch=1, compact_every=2
        )
        stream.awaitTermination()
        return rows(spark.read.parquet(out).select("board", "thread_number", "post_number"))

    first = run("one")
    assert len(first) == len(set(first)) and set(want) <= set(first)
    assert keyed.pointer(spark, ingest.post_keys(out)).version >= 3
    drop(inbox, "late.json", thread("g", 1, (0, 0, "old"), (999, 1, "new")))
    assert run("one") == sorted([*first, ("g", 1, 999)], key=str)
    # a new checkpoint comes upon folded keys
    assert run("two") == sorted([*first, ("g", 1, 999)], key=str)


def test_comments_over_compactions(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    for i, at in enumerate([3, 1, 5, 2, 4]):
        drop(inbox, f"{i}.json", listing("p", at, comment("a", f"v{at}"), comment(f"c{i}", "only")))
    ingest.stream_upsert(
        spark, str(inbox), out, str(tmp_path / "c"), per_batch=1, compact_every=2
    ).awaitTermination()
    got = {r.id: r for r in ingest.read_comments(spark, out).collect()}
    assert sorted(got) == ["a", "c0", "c1", "c2", "c3", "c4"]
    assert got["a"].cleaned_text == "v1" and '"v5"' in got["a"].data
    assert keyed.pointer(spark, ingest.comments_table(out)).folded
    posts = str(tmp_path / "posts")
    for i, at in enumerate([2, 9, 4]):
        drop(tmp_path / "in3", f"{i}.json", listing(None, at, {"id": "x", "score": at}, kind="t3"))
    ingest.stream_upsert_posts(
        spark, str(tmp_path / "in3"), posts, str(tmp_path / "d"), per_batch=1, compact_every=1
    ).awaitTermination()
    assert [(r.post_id, r.votes) for r in ingest.read_posts(spark, posts).collect()] == [("x", 9)]
