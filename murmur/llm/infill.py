"""Fill-in-middle: texts cut at line ends into prefix, middle and suffix, and put back.

A unit is a line with its line feed, or a last line without one. One fullmatch of
`(unit)*` keeps every repetition of its group, so the ends of the group are all places
where a text may be cut: their number is n, and the two offsets are read from them.
"""

from __future__ import annotations

import re

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import clean_text, ship
from murmur.llm.words import groups, utf8

ship(__name__)

# Both alternatives are possessive: a unit matches in one way only, so nothing is kept
# for a second try and a text of a million lines is one linear match.
UNIT = r"[^\n]*+\n|[^\n]++"
SENTINELS = ("<P>", "<S>", "<M>")
SEED = "7"
# Of 100 documents, so many are transformed, and so many of these put the suffix first.
RATE = 100
SUFFIX_FIRST = 50
# Texts that are worked on at once, in bytes; a longer text alone.
AT_ONCE = 4 << 20

FORMED = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def cutter(rate: int, suffix_first: int, sentinels: tuple[str, str, str], unit: str = UNIT):
    """Function of (text, hex digest) that gives n, form, prefix and middle length, output."""
    units = regex.compile(f"({unit})*+")
    p, s, m = sentinels

    def cut(text: str, digest: str):
        h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
        ends = units.fullmatch(text).ends(1)
        n = len(ends)
        if not text or h3 % 100 >= rate or any(x in text for x in sentinels):
            return n, "plain", None, None, text
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (ends[k - 1] if k else 0 for k in (low, high))
        if h4 % 100 < suffix_first:
            return n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
        return n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"

    return cut


def fill_in_middle(
    documents: DataFrame,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    seed: str = SEED,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output.

    The draw depends on `seed` and doc_id alone, so repeated rows of a document are cut
    alike and reruns agree; a null doc_id draws as an empty one. Null text counts as empty.
    An empty text, one that holds a sentinel and those left out by `rate` are "plain":
    output is the text and both lengths are null. Otherwise the form is "psm" or "spm";
    offsets are code points and each part may be empty. Other columns of `documents` are
    not read. An empty table gives no rows.
    """
    cut = cutter(rate, suffix_first, sentinels)

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            _, offsets = utf8(texts)
            for first, last in groups(offsets, AT_ONCE):
                part = batch.slice(first, last - first)
                rows = [
                    cut(text or "", digest)
                    for text, digest in zip(part.column("text").to_pylist(), part.column("digest").to_pylist())
                ]
                n, form, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.string()),
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        clean_text().alias("text"),
        F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).alias("digest"),
    ).mapInArrow(run, FORMED)


def restored_text(
    frame: DataFrame,
    name: str = "restored",
    output: str = "output",
    form: str = "form",
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """Adds the text rebuilt from output and form alone.

    A transformed text holds no sentinel of its own, and none can arise across the place
    where a part meets a sentinel, as no sentinel starts with another's end. So a split
    at sentinels gives nothing, and the three parts in the order of the form.
    """
    marks = "|".join(re.escape(x) for x in sentinels)
    part = F.split(F.col(output), marks, -1)
    frame = frame.withColumn("_parts", F.when(F.col(form) != "plain", part))

    def joined(*order: int) -> Column:
        return F.concat(*(F.element_at("_parts", k) for k in order))

    whole = (
        F.when(F.col(form) == "psm", joined(2, 4, 3))
        .when(F.col(form) == "spm", joined(3, 4, 2))
        .otherwise(F.col(output))
    )
    return frame.withColumn(name, whole).drop("_parts")


def infill_digest(documents: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    return restored_text(fill_in_middle(documents, **options)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


SQL = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, text, u, len(u) AS n,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
           CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM units
), cut AS (
    SELECT doc_id, text, n, h4,
           text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') AS plain,
           coalesce(array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], ''), '') AS prefix,
           coalesce(array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], ''), '') AS middle,
           coalesce(array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], ''), '') AS suffix
    FROM drawn
)
SELECT doc_id, n,
       CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(prefix) END AS prefix_chars,
       CASE WHEN NOT plain THEN length(middle) END AS middle_chars,
       sha256(CASE WHEN plain THEN text
                   WHEN h4 % 100 < 50 THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
