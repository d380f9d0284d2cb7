import os

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as P
from murmur.llm import entry
from murmur.llm.mixing import mix_documents
from tests.llm.test_jaccard import brute

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in P.STAGES:
        before, docs = docs, P.stored(stage(spark, docs, FOLDER), f"test-{name.replace(' ', '-')}")
        if name != "pieces":
            assert docs.columns == columns
        kept.append(docs.count())
        if name == "near copies":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            want = {c for i, n, c in brute(rows)}
            assert sorted(r.doc_id for r in docs.collect()) == sorted(want)
        if name == "mix":
            plan = {r.doc_id: r.copies for r in mix_documents(before).collect() if r.copies}
            got = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
            assert got == plan
    assert kept[0] >= 190 and kept[1] >= 150
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in docs.collect():
        assert np.array_equal(r.ids, library.encode(texts[r.doc_id], add_bos=True, add_eos=True))
    assert docs.count() == kept[-1] == P.run(spark, FOLDER).count()


def test_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(entry.SQL) <= set(entry.QUERIES)
    assert [name for name, _ in P.STAGES] == ["language", "toxicity", "near copies", "mix", "pieces"]


def test_odd_rows_pass_every_stage(spark):
    """Nulls, empty, very long and repeated rows, two texts of one doc_id, columns of any name."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    some = docs.orderBy("doc_id").limit(40).collect()
    clean = [r for r in some if r.lang == "en" and r.text and r.n_chars > 300][:2]
    text, other = (r.text for r in clean)
    long = " ".join([text] * 400)
    lang, source = clean[0].lang, clean[0].source
    odd = [
        (90001, None, lang, source), (90002, "", lang, source), (None, text, lang, source), (90003, long, lang, source),
        (90004, text, None, None), (90005, other, lang, source), (90005, text + " and more of it", lang, source),
        (90006, other, lang, source), (90006, other, lang, source),
    ]
    schema = "doc_id long, text string, lang string, source string"
    frame = spark.createDataFrame(odd, schema).withColumns(
        {c: F.lit("x") for c in ("row", "n", "score", "sentences", "class_id", "component", "copies", "size", "ids")}
    )
    kept = frame
    for name, stage in P.STAGES:
        before, kept = kept, P.stored(stage(spark, kept, FOLDER), f"odd-{name.replace(' ', '-')}")
        if name != "pieces":
            assert kept.columns == frame.columns
            allowed = {(r.doc_id, r.text) for r in before.collect()}
            assert {(r.doc_id, r.text) for r in kept.collect()} <= allowed
        if name == "near copies":
            # Of the copies one row is left, both texts of 90005 are judged on their own.
            assert kept.where("doc_id = 90006").count() == 0 and kept.where("doc_id is null").count() == before.where("doc_id is null").count()
            texts = [r.text for r in kept.where("doc_id is not null").collect()]
            assert len(texts) == len(set(texts))
    assert set(kept.columns) >= {"doc_id", "lang", "source", "ids"}


def test_batches_stay_small_in_every_stage(spark, monkeypatch):
    """Neither a stage nor a table that an operator stores on the way raises the size of batches."""
    from murmur.llm import common

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(20)
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, write = spark.conf.get(key), type(docs.write).parquet

    def parquet(self, *args, **options):
        seen.append(int(spark.conf.get(key)))
        return write(self, *args, **options)

    monkeypatch.setattr(type(docs.write), "parquet", parquet)
    try:
        spark.conf.set(key, "64m")
        for name, stage in P.STAGES:
            P.stored(stage(spark, docs, FOLDER), f"small-{name.replace(' ', '-')}")
        assert len(seen) > 10 and max(seen) <= 2 << 20
        spark.conf.set(key, "1m")
        assert common.small_batches(spark) == "1m" and spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)
