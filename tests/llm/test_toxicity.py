import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from murmur.llm import toxicity as T


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice("alpha beta gamma delta rho tau".split()) + rng.choice(["", ".", "\n"]) for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(["scum,", "Scum.", "vilest", "vileness"])
        rows.append({"doc_id": i, "text": " ".join(words), "toxic": int(toxic)})
    return rows


def test_sentences_and_features():
    text = "One two. three\nfour! Five, six? é " + "w " * 130
    (group,) = T.features(pa.array([text, None, "last"]))
    bucket, number, starts, ends, per_text, n = group
    raw = text.encode()
    got = [raw[s:e].decode() for s, e in zip(starts[:-1], ends[:-1])]
    assert got[:4] == ["One two.", "three", "four!", "Five, six?"]
    assert [len(g.split()) for g in got[4:]] == [60, 60, 11] and per_text.tolist() == [7, 0, 1] and n == 3
    one, two = ([g for g in T.features(pa.array([t]))][0][0] for t in ("(Scum),", "scum"))
    assert one.tolist() == two.tolist()


def test_finds_documents_and_sentences(spark, docs):
    rows = made(900, 1)
    labels = spark.createDataFrame([(r["doc_id"], 1, r["toxic"]) for r in rows], "doc_id long, quality int, toxic int")
    extra = [{"doc_id": 2000}, {"doc_id": 2001, "text": ""}, {"text": "scum"}, {"doc_id": 2002, "text": "fine words " * 20000 + "scum."}]
    frame = docs(rows + extra).withColumn("score", F.lit("x")).withColumn("row", F.lit(1))
    got = {r.doc_id: r for r in T.score_documents(frame, labels).collect()}
    assert len(got) == 904
    for i, r in got.items():
        assert r.held_out == (zlib.crc32((str(i) if i is not None else "").encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in rows if got[r["doc_id"]].held_out]
    right = sum(got[r["doc_id"]].predicted == r["toxic"] for r in held)
    assert right >= 0.97 * len(held)
    bad = next(r for r in held if r["toxic"] and got[r["doc_id"]].predicted)
    spans = [bad["text"].encode()[s.start : s.end].decode().lower() for s in got[bad["doc_id"]].sentences]
    assert any("scum" in s or "vile" in s for s in spans)
    assert got[2000].score == got[2001].score == 0 and got[None].predicted == 1 and got[2002].predicted == 1
    left = T.clean_documents(frame, T.train(frame, labels))
    assert left.columns == frame.columns
    assert {r.doc_id for r in left.collect()} == {i for i, r in got.items() if not r.predicted}


def test_labels_of_the_fold_are_not_used(spark):
    rows = [(i, 1, i % 2) for i in range(50)] + [(1, 0, 0), (None, 1, 1), (3, 1, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    chosen = {r.doc_id: r.toxic for r in T.chosen_labels(labels, 10).collect()}
    assert len(chosen) == 20 and all(zlib.crc32(str(i).encode()) % 5 for i in chosen)
    assert all(t == i % 2 for i, t in chosen.items())


def test_nothing_to_learn(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert T.score_documents(docs([]), none).collect() == []
    (row,) = T.score_documents(docs([{"doc_id": 1, "text": "a b"}]), none).collect()
    assert row.predicted == 0
    w, b = T.fit(pa.array(["", ""]), np.array([0, 1]))
    assert not w.any() and b == T.PRIOR
