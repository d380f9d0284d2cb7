import random

import numpy as np
from pyspark.sql import functions as F

from murmur.llm import language as L

WORDS = {
    "en": "the and of with thing that which there other would could should".split(),
    "de": "der und nicht schule zwischen straße über möglich gegen wurde".split(),
    "fr": "les été avec pour où être déjà beaucoup toujours aujourd'hui".split(),
}


def text(lang, n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def labelled(docs):
    return docs([{"doc_id": i, "text": text(l, 80, i), "lang": l, "source": f"s{l}"} for i, l in enumerate(list(WORDS) * 15)])


def test_likelihood_is_per_text():
    import pyarrow as pa

    table = np.log(np.random.default_rng(1).random((3, 1 << L.BITS)) + 0.1)
    texts = ["abc déf", "", None, "x", "! 1", "the end"]
    run = L._liker(table, "text", False)
    both = next(run([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))
    for i, t in enumerate(texts):
        one = next(run([pa.RecordBatch.from_arrays([pa.array([t], pa.string())], ["text"])]))
        assert one.column("letters")[0].as_py() == both.column("letters")[i].as_py()
        np.testing.assert_allclose(one.column("likelihood")[0].as_py(), both.column("likelihood")[i].as_py(), rtol=1e-4, atol=1e-4)
        bucket, counts = L.trigrams(np.frombuffer((t or "").encode(), np.uint8))
        want = table[:, bucket[counts]].sum(axis=1)
        np.testing.assert_allclose(want, both.column("likelihood")[i].as_py(), rtol=1e-3, atol=1e-3)


def test_pages(spark, docs):
    rows = []
    for i, l in enumerate(list(WORDS) * 20):
        rows.append((i, f"https://www.{l}.example.org/{i}", f'<html lang="{l}"><script>der und</script><p>{text(l, 40, i)}</p>'))
    rows += [
        (900, "https://www.fr.example.org/x", "<p>ab cd</p>"),  # the host decides
        (901, "http://new.example.de", "<p>ab cd</p>"),  # the suffix decides
        (902, "http://new2.example.com", '<html lang="fr-CA"><p>ab cd</p>'),  # the markup decides
        (903, None, None), (904, "no address", ""), (905, "http://a.b/", "<p>12 34</p>"),
        (906, "http://z.example.com/", "<p>" + "кот дом мир лес " * 50 + "</p>"),
        (0, rows[0][1], rows[0][2]),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("own", F.lit(1)).withColumn("vote", F.lit(1))
    got = L.identify_pages(pages, labelled(docs)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert all(by[i].language == l and by[i].accepted for i, l in enumerate(list(WORDS) * 20))
    assert by[900].language == "fr" and by[901].language == "de" and by[902].language == "fr"
    for i in (903, 904, 905, 906):
        assert by[i].language == "und" and not by[i].accepted
    assert by[900].host == "www.fr.example.org" and by[903].host == ""


def test_documents(spark, docs):
    frame = docs(
        [{"doc_id": i, "text": text(l, 30, 100 + i), "lang": l, "source": l} for i, l in enumerate(list(WORDS) * 10)]
        + [{"doc_id": 200, "text": "1234"}, {"doc_id": 201}, {"doc_id": 202, "text": ""},
           {"doc_id": 203, "text": text("fr", 30, 5)}, {"doc_id": 204, "text": text("en", 60000, 5), "lang": "en"},
           {"doc_id": 204, "text": text("en", 60000, 5), "lang": "en"}]
    ).withColumn("host", F.lit(1)).withColumn("likelihood", F.lit(2))
    out = L.accepted_documents(frame, labelled(docs))
    assert out.columns == frame.columns
    assert sorted(r.doc_id for r in out.collect()) == [*range(30), 203, 204, 204]


def test_nothing(spark, docs):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert L.identify_pages(empty, labelled(docs)).collect() == []
    assert L.accepted_documents(docs([]), docs([])).collect() == []
    page = spark.createDataFrame([(1, "http://a.de/", "<p>der</p>")], empty.schema)
    (row,) = L.identify_pages(page, docs([])).collect()
    assert row.language == "und" and not row.accepted


def test_every_label_is_a_language(spark, docs):
    """More languages than thirty, each with words of its own."""
    rng = random.Random(9)
    tongues = {f"{a}{b}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)]
               for a in "xyz" for b in "abcdefghijklmn"}
    assert len(tongues) == 42

    def rows(n, start):
        return [{"doc_id": start + i * 100 + j, "text": " ".join(rng.choice(w) for _ in range(60)), "lang": l, "source": "s"}
                for i, (l, w) in enumerate(tongues.items()) for j in range(n)]

    learn, asked = rows(3, 0), rows(1, 10_000)
    pages = spark.createDataFrame(
        [(r["doc_id"], f"http://{r['lang']}.example.org/", f"<html lang='{r['lang']}'><p>{r['text']}</p>") for r in asked],
        "page_id long, url string, html string")
    got = {r.page_id: r for r in L.identify_pages(pages, docs(learn)).collect()}
    assert all(got[r["doc_id"]].language == got[r["doc_id"]].declared_language == r["lang"] for r in asked)
    assert L.accepted_documents(docs(asked), docs(learn)).count() == len(asked)
