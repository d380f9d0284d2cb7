"""A training corpus from `documents`: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir), where docs has the columns of `documents`, and
returns a DataFrame, which `run` writes to the shared scratch folder and reads back. All
but the last return the columns of docs, whatever these are. An empty table passes through
every stage. Rows go to Python in small batches, which stages set in their session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from murmur.llm import jaccard, language, mixing, pieces, toxicity
from murmur.llm.common import small_batches, stored, table
from murmur.llm.entry import tokenizer

# Rows go to Python in batches of so many bytes: the stages share their workers, and what one
# has touched is still there in the next, so each has to be small.
BATCH_BYTES = 2 << 20


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text, declared language and source agree on a known language.

    Texts without a letter (null and empty ones too) and those unlike every language go.
    """
    small_batches(spark, BATCH_BYTES)
    return language.accepted_documents(docs, table(spark, sf_dir, "documents"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of toxicity below 0.5; the model learns from the labelled documents given."""
    small_batches(spark, BATCH_BYTES)
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.clean_documents(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id."""
    small_batches(spark, BATCH_BYTES)
    return jaccard.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it whole: never, once or twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the piece ids of every text, begin and end ids included."""
    small_batches(spark, BATCH_BYTES)
    return pieces.encode_pieces(docs, tokenizer("piece_bpe_32k.model")).select(
        "doc_id", "lang", "source", "ids"
    )


STAGES = [
    ("language", keep_known_languages),
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("mix", mix_sources),
    ("pieces", encode),
]

# The stages are learned models, a 64-bit hash join and a tokenizer: no SQL says them. The
# tests hold run() against the operators' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name.replace(' ', '-')}")
    return docs
