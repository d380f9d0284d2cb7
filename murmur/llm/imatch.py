"""I-Match fingerprints: hashes of the terms of middling frequency, over several random lexicons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import WORD, clean_text, numbered, stored

# Terms in at least / at most this share of all documents (and in two at least). The sum
# of document frequencies is documents x terms per document, so the lexicon has at most
# (mean distinct terms of a document) / LEAST entries, however many documents there are.
LEAST = 0.0005
MOST = 0.005
# Random lexicons: one in `d` of the terms, SEEDS times for each d. Sparse lexicons meet
# few terms of a text and so stand edits; dense ones tell short texts apart.
ONE_IN = (4, 16, 64, 256)
SEEDS = 5
EMPTY = 0


def distinct_terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def lexicon(texts: DataFrame, column: str = "text", least: float = LEAST, most: float = MOST) -> DataFrame:
    """term (64-bit hash) of the chosen idf band; document frequencies over all rows.

    least <= df / documents <= most, but df of 2 at least, and of 2 always allowed.
    """
    total = texts.count()
    low, high = max(2, least * total), max(2, most * total)
    return (
        texts.select(F.explode(distinct_terms(F.col(column))).alias("word"))
        .groupBy(F.xxhash64("word").alias("term"))
        .agg(F.count(F.lit(1)).alias("df"))
        .where((F.col("df") >= low) & (F.col("df") <= high))
        .select("term")
    )


def subset_hashes(terms: Column) -> Column:
    """For each random lexicon, a 32-bit hash of the sorted terms in it; EMPTY if none is.

    The draw is a hash of term and lexicon number, the same for every text.
    """

    def of(d: int, seed: int) -> Column:
        number = F.lit(d * 100 + seed)
        chosen = F.filter(terms, lambda t: F.pmod(F.xxhash64(t, number), F.lit(d)) == 0)
        # 1 to 2^32 - 1, so never EMPTY.
        hashed = F.pmod(F.xxhash64(chosen), F.lit((1 << 32) - 1)) + 1
        return F.when(F.size(chosen) > 0, hashed).otherwise(F.lit(EMPTY).cast("bigint"))

    return F.array(*[of(d, seed) for d in ONE_IN for seed in range(SEEDS)])


def fingerprint_of(mark: Column) -> Column:
    """The hashes in hex; where no lexicon meets the text, its sha256, so it is like equal texts only."""
    text = F.array_join(F.transform(mark["hashes"], lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")
    met = F.exists(mark["hashes"], lambda h: h != EMPTY)
    return F.when(met, text).otherwise(F.concat(F.lit("text:"), mark["sha"]))


def likeness(a: Column, b: Column) -> Column:
    """Share of the lexicons that meet either text whose hashes agree; 1 for equal texts."""
    both = F.arrays_zip(a["hashes"].alias("x"), b["hashes"].alias("y"))
    live = F.filter(both, lambda z: (z["x"] != EMPTY) | (z["y"] != EMPTY))
    agree = F.filter(live, lambda z: z["x"] == z["y"])
    return (
        F.when(a["sha"] == b["sha"], F.lit(1.0))
        .when(F.size(live) == 0, F.lit(0.0))
        .otherwise(F.size(agree) / F.size(live))
        .cast("double")
    )


def fingerprints(texts: DataFrame, keys: list[str], columns: list[str], band: DataFrame) -> DataFrame:
    """keys and, for each of the text columns, a struct of that name: hashes, and sha256 of the text.

    `keys` tell rows apart. Terms outside the band are dropped by a join with the lexicon,
    which is bounded (see LEAST) and so sent to all executors. Where the rows are already
    partitioned by `keys`, nothing is shuffled.
    """
    sides = F.array(
        *[F.struct(F.lit(i).alias("side"), F.col(c).alias("text")) for i, c in enumerate(columns)]
    )
    hit = (
        texts.select(*keys, F.explode(sides).alias("s"))
        .select(*keys, "s.side", F.explode(distinct_terms(F.col("s.text"))).alias("word"))
        .select(*keys, "side", F.xxhash64("word").alias("term"))
        .join(F.broadcast(band), "term")
    )
    none = F.array().cast("array<bigint>")
    terms = hit.groupBy(*keys).agg(
        *[F.collect_list(F.when(F.col("side") == i, F.col("term"))).alias(f"_{c}") for i, c in enumerate(columns)]
    )
    marks = [F.sha2(F.encode(c, "UTF-8"), 256).alias(f"sha_{c}") for c in columns]
    joined = texts.select(*keys, *marks).join(terms, keys, "left")
    return joined.select(
        *keys,
        *[
            F.struct(
                subset_hashes(F.sort_array(F.coalesce(f"_{c}", none))).alias("hashes"),
                F.col(f"sha_{c}").alias("sha"),
            ).alias(c)
            for c in columns
        ],
    )


def fingerprint_documents(
    documents: DataFrame, least: float = LEAST, most: float = MOST, name: str = "imatch"
) -> DataFrame:
    """Fingerprints of whole texts and of their edited texts, and how alike they are.

    The edited text of a document has its last floor(n_chars / 3) code points replaced by
    the first as many (or all) of the next document in descending doc_id, the first after
    the last. Null text counts as empty. Rows with one doc_id are ordered by text; rows
    equal in both count as one document there and get equal results. A lone document is
    its own next. Columns other than doc_id and text are not read.

    The texts are shuffled once, by document; what a document hands to the one before is a
    third of that at most. Everything else moves ids, hashes or fingerprints.
    """
    key = ["id", "mark"]
    keyed = documents.select("doc_id", clean_text().alias("text")).select(
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64("text", F.col("doc_id").isNull()).alias("mark"),
        "doc_id",
        "text",
    )
    order = (
        keyed.select(*key, "doc_id", F.length("text").cast("bigint").alias("n_chars"))
        .groupBy(*key, "doc_id", "n_chars")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    order = numbered(order, ["doc_id", "mark"], f"{name}-order")
    total = max(order.count(), 1)
    next_of = order.select(
        F.col("id").alias("next_id"),
        F.col("mark").alias("next_mark"),
        F.pmod(F.col("row") + 1, F.lit(total)).alias("row"),
    )
    pairs = order.join(next_of, "row").select(
        *key, "doc_id", "n_chars", "rows", "next_id", "next_mark",
        F.floor(F.col("n_chars") / 3).cast("int").alias("cut"),
    )
    # Both uses of the texts, as the document and as the next one, read this one shuffle.
    once = (
        keyed.select(*key, "text")
        .withColumn("_no", F.row_number().over(Window.partitionBy(*key).orderBy(*key)))
        .where("_no = 1")
        .drop("_no")
    )
    gifts = (
        once.withColumnsRenamed({"id": "next_id", "mark": "next_mark"})
        .join(pairs.select("next_id", "next_mark", *key, "cut"), ["next_id", "next_mark"])
        .select(*key, F.expr("substring(text, 1, cut)").alias("gift"))
    )
    texts = (
        once.join(pairs.select(*key, "n_chars", "cut"), key)
        .join(gifts, key)
        .select(
            *key,
            F.col("text").alias("own"),
            F.concat(F.expr("substring(text, 1, int(n_chars) - cut)"), F.col("gift")).alias("other"),
        )
    )
    band = lexicon(keyed, "text", least, most)
    prints = fingerprints(texts, key, ["own", "other"], band)
    # Read twice (as itself and as the next one), so kept; 500 bytes a document.
    prints = stored(prints, name)
    following = prints.select(
        F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("own").alias("following")
    )
    return (
        prints.join(pairs, key)
        .join(following, ["next_id", "next_mark"])
        .withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
        .select(
            "doc_id",
            "n_chars",
            F.col("other.sha").alias("edited_sha256"),
            fingerprint_of(F.col("own")).alias("fingerprint"),
            fingerprint_of(F.col("other")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("other")).alias("near_edited"),
            likeness(F.col("own"), F.col("following")).alias("near_next"),
        )
    )
