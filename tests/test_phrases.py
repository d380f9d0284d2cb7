import random
import time

from pyspark.sql import functions as F

from murmur.operators import filters, topics

LETTERS = "abcdé 日"


def phrases(n, seed=1, size=(3, 12)):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(*size))) for _ in range(n)]


def texts(spark, n, seed=2):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice(LETTERS + "AB") for _ in range(rng.randint(0, 60))), rng.choice([None, "", "xAbCx"])) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, None)], "id int, title string, text string")


def ids(frame):
    return sorted(r.id for r in frame.collect())


def test_an_automaton_finds_what_single_searches_find(spark, monkeypatch):
    frame = texts(spark, 400)
    for n in (1, 5, 60, 400):
        wanted = phrases(n, n, (2, 5)) + ["abc", "bca"]
        many = ids(frame.where(filters.any_phrase_finder(wanted)(F.lower("title")) | F.coalesce(filters.any_phrase_finder(wanted)(F.lower("text")), F.lit(False))))
        plain = {r.id for r in frame.collect() for t in (r.title, r.text) if t is not None and any(p in t.lower() for p in wanted)}
        assert set(many) <= plain
        assert ids(filters.match_any_phrase(frame, ["title", "text"], wanted)) == sorted(plain)
        with monkeypatch.context() as m:
            m.setattr(filters, "FEW_PHRASES", 0)
            assert ids(filters.match_any_phrase(frame, ["title", "text"], wanted)) == sorted(plain)
    assert ids(filters.match_any_phrase(frame, ["title"], [])) == []
    with monkeypatch.context() as m:
        m.setattr(filters, "FEW_PHRASES", 0)
        assert ids(filters.match_any_phrase(frame, ["title"], ["", "x"])) == list(range(400))


def test_time_does_not_grow_with_phrases(spark):
    frame = texts(spark, 20_000).repartition(4).cache()
    frame.count()

    def spent(n):
        wanted = phrases(n, 3, (9, 12))
        filters.match_any_phrase(frame, ["title"], wanted).count()
        begin = time.time()
        filters.match_any_phrase(frame, ["title"], wanted).count()
        return time.time() - begin

    few, many = spent(100), spent(5000)
    frame.unpersist()
    assert many < 4 * few + 1


def test_boards_with_many_texts(spark):
    rows = [(i, "g", t) for i, t in enumerate(["has Word7 in it", "none", None, "WORD99"])] + [(9, "pol", "word7")]
    frame = spark.createDataFrame(rows, "id int, board string, cleaned_text string")
    wanted = [f"Word{i}" for i in range(100)]
    assert ids(topics.board("g", wanted)(frame, None)) == [0, 3]
    assert ids(topics.board("g", wanted[:10])(frame, None)) == [0, 3]
