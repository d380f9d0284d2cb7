"""The queries of this package over the provided tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from murmur.llm import codes, forest, huffman, imatch, infill, jaccard, language, links, mixing
from murmur.llm import pieces, repeats, sharding, toxicity
from murmur.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    """A public vocabulary file; the folder is an installed package on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.search_embeddings(table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_pages(
        table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    )


def op4_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.judge_pages(table(spark, sf_dir, "pages"))


def op5_token_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.token_digest(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op6_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digest(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digest(table(spark, sf_dir, "documents"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_digest(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_prefix_forest": op2_prefix_forest,
    "op3_language_id": op3_language_id,
    "op4_url_trust": op4_url_trust,
    "op5_token_huffman": op5_token_huffman,
    "op6_toxicity_mil": op6_toxicity_mil,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_imatch": op8_imatch,
    "op9_mix": op9_mix,
    "op10_shards": op10_shards,
    "op11_infill": op11_infill,
    "op12_repeats": op12_repeats,
    "op13_vector_codes": op13_vector_codes,
}
SQL: dict[str, str] = {
    "op9_mix": mixing.SQL,
    "op11_infill": infill.SQL,
    "op12_repeats": repeats.SQL,
    "op13_vector_codes": codes.SQL,
}
