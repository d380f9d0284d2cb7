"""Text columns: HTML cleaning, tokens, keywords, moderation records, polarity."""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.functions.fixed import AI_KEYWORDS, LEFT_ESCAPES, STOP_WORDS, WORD_PATTERN
from murmur.functions.scalars import let, numeric_coerce

# Largest dictionary lexicon that is looked up inside the row.
LEXICON_WORDS = 100_000

SPACES = r"[\p{IsWhite_Space}\x1c-\x1f]+"
# A quoted attribute value may hold `>`; an unclosed quote ends with the tag.
TAG = (
    r"</?[A-Za-z][^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')?+[^>=]*+)*+>"
    r"|<[!?][^>]*>"
)


def _element_pattern(tag: str, css_class: str) -> str:
    return (
        rf"(?is)<{tag}\b(?=[^>]*\bclass\s*=\s*[\"']?[^\"'>]*\b{css_class}\b)[^>]*>"
        rf".*?</{tag}\s*>"
    )


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


# A literal map is searched from its start, so a table is dealt into maps of about this many.
ENTRIES_PER_MAP = 32


def table_lookup(table: dict[str, object], key: Column, dtype: str) -> Column:
    """The value of `key` in a fixed table, null if it is not there. Stays in the row.

    The table is one literal, which the planner reads once.
    """
    count = max(1, len(table) // ENTRIES_PER_MAP)
    maps: list[dict] = [{} for _ in range(count)]
    for known, value in table.items():
        maps[zlib.crc32(known.encode()) % count][known] = value if isinstance(value, int) else str(value)
    dealt = F.from_json(F.lit(json.dumps(maps)), f"array<map<string,{dtype}>>")
    place = F.pmod(F.crc32(F.encode(key, "UTF-8")), F.lit(count)).cast("int")
    return F.element_at(F.get(dealt, place), key)


def _named_character(name: Column) -> Column:
    """Characters of an HTML 5 name, null if there is no such name."""
    return table_lookup({known.rstrip(";"): c for known, c in html5.items()}, name, "string")


def _c1_characters() -> Column:
    """References 128..159 mean Windows-1252 characters in HTML."""
    table = {
        code: bytes([code]).decode("cp1252", errors="ignore") or chr(code)
        for code in range(128, 160)
    }
    return _literal_map(table)


def _character(code: Column) -> Column:
    usable = (
        (code > 0)
        & (code <= 0x10FFFF)
        & ~code.between(0xD800, 0xDFFF)
    )
    utf32 = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code.between(128, 159), F.element_at(_c1_characters(), code.cast("int")))
        .when(usable, utf32)
        .otherwise(F.lit("�"))
    )


def _decode_reference(piece: Column) -> Column:
    """`piece` is the text after an ampersand."""
    decimal = F.regexp_extract(piece, r"^#([0-9]{1,9});?", 1)
    hexadecimal = F.regexp_extract(piece, r"^#[xX]([0-9A-Fa-f]{1,7});?", 1)
    name = F.regexp_extract(piece, r"^([A-Za-z][A-Za-z0-9]{1,31})(?![A-Za-z0-9])", 1)
    rest = F.regexp_replace(piece, r"^(#[0-9]{1,9};?|#[xX][0-9A-Fa-f]{1,7};?|[A-Za-z0-9]+;?)", "")
    char = (
        F.when(decimal != "", _character(decimal.try_cast("bigint")))
        .when(hexadecimal != "", _character(F.conv(hexadecimal, 16, 10).try_cast("bigint")))
        .when(name != "", _named_character(name))
    )
    return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))


def decode_entities(text: Column) -> Column:
    """Decode character references once, left to right.

    Numeric references and the HTML 5 names are known, closed by a semicolon or by anything
    that is no letter or digit; other names stay as text.
    """

    def decoded(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, 2, F.size(pieces)), _decode_reference)
        return F.concat(pieces[0], F.array_join(tail, ""))

    return let(F.split(text, "&"), decoded)


# Stands where an element was removed: a tag, so that what is left and right of it stays apart.
GONE = "<!>"
# Up to so many elements are looked for without a guard: each that has no end costs one look
# through the rest of the text.
FEW_OPENED = 32


def _removed_to_last_end(text: Column, pattern: str, end: str) -> Column:
    """`text` without what the pattern matches, which ends in `end`.

    Nothing after the last end can match. Before it every beginning finds an end, so the time
    is linear however many are left open.
    """

    def removed(whole: Column) -> Column:
        return let(
            F.regexp_extract(whole, rf"(?is)\A(.*{end})", 1),
            lambda head: F.concat(
                F.regexp_replace(head, pattern, GONE), whole.substr(F.length(head) + 1, F.length(whole))
            ),
        )

    return let(text, removed)


def _texts_between_tags(text: Column) -> Column:
    """Tags end in ``>``, so nothing after the last one is looked at."""
    rest = F.substring_index(text, ">", -1)
    return let(
        rest,
        lambda tail: F.concat(
            F.split(text.substr(F.lit(1), F.length(text) - F.length(tail)), TAG), F.array(tail)
        ),
    )


def clean_html_text(html: Column, tag: str = "a", css_class: str = "quotelink") -> Column:
    """Readable text of an HTML fragment; '' for null.

    Scripts, styles, comments and the elements `tag.css_class` are removed whole.
    Tags vanish without leaving a space. A tag or a removed element ends a character
    reference before it, and none is read across one. Escapes that survive one decoding
    (text that was escaped twice) are then replaced, angle brackets dropped,
    runs of white space inside a line become one space and blank lines go.
    """
    parts = [
        (r"(?is)<script\b[^>]*+>.*?</script\s*+>", r"</script\s*+>"),
        (r"(?is)<style\b[^>]*+>.*?</style\s*+>", r"</style\s*+>"),
        (r"(?s)<!--.*?-->", "-->"),
        (_element_pattern(tag, css_class), rf"</{tag}\s*+>"),
    ]
    opened = F.regexp_count(html, F.lit(rf"(?i)<(?:script\b|style\b|!--|{tag}\b)"))
    plain, guarded = html, html
    for pattern, end in parts:
        plain = F.regexp_replace(plain, pattern, GONE)
        guarded = _removed_to_last_end(guarded, pattern, end)
    text = F.when(opened > FEW_OPENED, guarded).otherwise(plain)
    texts = F.transform(
        let(text, _texts_between_tags),
        lambda piece: F.when(piece.contains("&"), decode_entities(piece)).otherwise(piece),
    )
    text = F.array_join(texts, "")
    for escape, plain in LEFT_ESCAPES:
        text = F.replace(text, F.lit(escape), F.lit(plain))
    lines = F.transform(
        F.split(text, "\n"), lambda line: F.trim(F.regexp_replace(line, SPACES, " "))
    )
    return F.coalesce(F.array_join(F.filter(lines, lambda line: line != ""), "\n"), F.lit(""))


def lexicon_frame(spark: SparkSession, lexicon: dict[str, float]) -> DataFrame:
    """Word polarities as a frame. Decimals keep sums exact in any order. Of words that differ
    in case only the last counts."""
    last = {w.lower(): str(p) for w, p in lexicon.items()}
    rows = pd.DataFrame({"token": list(last), "polarity": list(last.values())})
    frame = spark.createDataFrame(rows, "token string, polarity string").select(
        "token", F.col("polarity").cast("decimal(6,4)").alias("polarity")
    )
    return frame


def words(text: Column) -> Column:
    """Lower-case words of a text, in order, with repeats."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD_PATTERN})"), F.lit(1))


def tokenize_words(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Words longer than two characters that are not stop words."""
    return F.filter(words(text), lambda w: (F.length(w) > 2) & ~w.isin(stop_words))


def keyword_terms(text: Column, keywords: list[str] = AI_KEYWORDS) -> Column:
    """Keywords of a text, with repeats.

    Only runs of the letters a-z form words, so a keyword that holds a hyphen
    never matches.
    """
    letters = F.regexp_extract_all(F.lower(text), F.lit("([a-z]+)"), F.lit(1))
    return F.filter(letters, lambda w: w.isin(keywords))


def parse_moderation(response: Column) -> Column:
    """Moderation response to a struct (score, class, score_text).

    An unreadable response, or a confidence that is there but not a number,
    gives (0.0, '', '0.00'). An absent confidence is 0.0 and keeps the class.
    """

    def score_of(record: Column) -> Column:
        text = F.lower(F.trim(record["confidence"]))
        return (
            F.when(~F.map_contains_key(record, "confidence"), F.lit(0.0))
            .when(text == "true", F.lit(1.0))
            .when(text == "false", F.lit(0.0))
            .otherwise(numeric_coerce(text))
        )

    def label_of(record: Column) -> Column:
        return F.when(F.map_contains_key(record, "class"), F.coalesce(record["class"], F.lit("None")))

    def result(record: Column) -> Column:
        return let(
            score_of(record),
            lambda score: F.struct(
                F.coalesce(score, F.lit(0.0)).alias("score"),
                F.coalesce(F.when(score.isNotNull(), label_of(record)), F.lit("")).alias("class"),
                F.format_string("%.2f", F.coalesce(score, F.lit(0.0))).alias("score_text"),
            ),
        )

    return let(F.from_json(response, "map<string,string>"), result)


def _polarity_in_row(found: Column, lexicon: dict[str, float]) -> Column:
    scores = {word.lower(): Decimal(str(score)) for word, score in lexicon.items()}
    if not scores:
        return F.lit(0.0)
    known = F.filter(found, lambda w: w.isin(list(scores)))
    zero = F.lit(0).cast("decimal(38,4)")

    def mean(hits: Column) -> Column:
        total = F.aggregate(
            hits, zero, lambda a, w: (a + table_lookup(scores, w, "decimal(6,4)")).cast("decimal(38,4)")
        )
        some = F.size(hits) > 0
        return F.round(F.when(some, total.cast("double") / F.size(hits)).otherwise(F.lit(0.0)), 2)

    return let(known, mean)


@dataclass(frozen=True)
class Modifiers:
    """Words that change the polarity of what follows.

    negations turn it round and halve it ("not good" is half as bad as "good" is good).
    intensities multiply it, one after another ("very": 1.3). Both last until the next known
    word, over at most `reach` words that are neither.
    """

    negations: tuple[str, ...] = ()
    intensities: dict[str, float] = field(default_factory=dict)
    reach: int = 1


# Polarities are held in ten-thousandths and intensities in hundredths. A negation counts
# -1 and its absence 2, so a polarity of 1 is this much.
POLARITY, INTENSITY = 10_000, 100
FULL = 2 * POLARITY * INTENSITY
MATCH = "struct<size:int,score:bigint>"


def _scaled(value, scale: int) -> int:
    return int((Decimal(str(value)) * scale).to_integral_value(ROUND_HALF_UP))


def _grams(tokens: Column, at: Column, size: int) -> Column:
    """`size` words from place `at` on with blanks between; null at the end of the text."""
    return F.when(at + size <= F.size(tokens), F.array_join(F.slice(tokens, at + 1, size), " "))


def _places(tokens: Column) -> Column:
    return F.when(F.size(tokens) > 0, F.sequence(F.lit(0), F.size(tokens) - 1)).otherwise(
        F.array().cast("array<int>")
    )


def _walked(tokens: Column, matches: Column, modifiers: Modifiers) -> Column:
    """Mean polarity of the matches (one or null for each place), by one walk over the words.

    The longest entry at a place counts, and none that begins inside it. A match takes what
    modifiers left, is held within -1 and 1, and clears them.
    """
    whole = INTENSITY
    strengths = {w.lower(): _scaled(v, INTENSITY) for w, v in modifiers.intensities.items()}
    turns = [w.lower() for w in modifiers.negations]

    def state(total, hits, factor, negated, idle, skip) -> Column:
        parts = (("total", total, "bigint"), ("hits", hits, "int"), ("factor", factor, "bigint"),
                 ("negated", negated, "boolean"), ("idle", idle, "int"), ("skip", skip, "int"))
        return F.struct(*((c if isinstance(c, Column) else F.lit(c)).cast(t).alias(n) for n, c, t in parts))

    def step(s: Column, at: Column) -> Column:
        word, match = tokens[at], matches[at]
        value = match["score"] * s["factor"] * F.when(s["negated"], -1).otherwise(2)
        held = F.least(F.greatest(value, F.lit(-FULL)), F.lit(FULL))
        out = F.when(
            s["skip"] > 0, state(s["total"], s["hits"], s["factor"], s["negated"], s["idle"], s["skip"] - 1)
        ).when(
            match.isNotNull(), state(s["total"] + held, s["hits"] + 1, whole, False, 0, match["size"] - 1)
        )
        if turns:
            out = out.when(word.isin(turns), state(s["total"], s["hits"], s["factor"], True, 0, 0))
        if strengths:
            known = table_lookup(strengths, word, "bigint")
            stronger = F.least(F.floor(s["factor"] * known / INTENSITY), F.lit(100 * whole))
            out = out.when(known.isNotNull(), state(s["total"], s["hits"], stronger, s["negated"], 0, 0))
        on = s["idle"] < modifiers.reach
        return out.when(
            on, state(s["total"], s["hits"], s["factor"], s["negated"], s["idle"] + 1, 0)
        ).otherwise(state(s["total"], s["hits"], whole, False, 0, 0))

    def mean(s: Column) -> Column:
        some = s["total"].cast("double") / (s["hits"] * F.lit(float(FULL)))
        return F.round(F.when(s["hits"] > 0, some).otherwise(F.lit(0.0)), 2)

    return F.aggregate(_places(tokens), state(0, 0, whole, False, 0, 0), step, mean)


def _matches_in_row(tokens: Column, scores: dict[str, int], longest: int) -> Column:
    def at_place(at: Column) -> Column:
        found = F.lit(None).cast(MATCH)
        for size in range(1, longest + 1):
            score = table_lookup(scores, _grams(tokens, at, size), "bigint")
            match = F.struct(F.lit(size).alias("size"), score.alias("score"))
            found = F.when(score.isNotNull(), match).otherwise(found)
        return found

    return F.transform(_places(tokens), at_place)


def _entries(lexicon: dict[str, float]) -> dict[str, int]:
    """Lower-case entries with single blanks; of entries that are alike the last counts."""
    return {" ".join(k.lower().split()): _scaled(v, POLARITY) for k, v in lexicon.items() if k.split()}


def modified_polarity(
    frame: DataFrame,
    keys: list[str],
    text_col: str,
    lexicon: dict[str, float] | DataFrame,
    modifiers: Modifiers = Modifiers(),
    longest: int = 3,
) -> DataFrame:
    """`sentiment_polarity` with phrases, negation and intensity: (keys, polarity).

    Entries of the lexicon are words or phrases of up to `longest` words; case and blanks
    between words do not count, and of entries that are alike the last counts (of a frame,
    `token` and `polarity`, the greatest). Null or empty texts have no row, others one each,
    repeated rows too; without a known word it is 0.0.

    A dictionary of up to LEXICON_WORDS entries is looked up in the row. A frame or a larger
    one meets the words of each distinct text in a join, and the walk is the same.
    """
    texts = frame.where(F.col(text_col).isNotNull() & (F.col(text_col) != ""))
    if isinstance(lexicon, dict):
        scores = _entries(lexicon)
        if len(scores) <= LEXICON_WORDS:
            longest = min(longest, max((k.count(" ") + 1 for k in scores), default=1))
            polarity = let(
                words(F.col(text_col)),
                lambda t: let(_matches_in_row(t, scores, longest), lambda m: _walked(t, m, modifiers)),
            )
            return texts.select(*keys, polarity.alias("polarity"))
        rows = pd.DataFrame({"gram": list(scores), "score": list(scores.values())})
        known = frame.sparkSession.createDataFrame(rows, "gram string, score bigint")
    else:
        scaled = F.round(F.col("polarity").cast("decimal(20,10)") * POLARITY).cast("bigint")
        gram = F.trim(F.regexp_replace(F.lower("token"), SPACES, " "))
        known = lexicon.select(gram.alias("gram"), scaled.alias("score")).where("gram != ''")
        known = known.groupBy("gram").agg(F.max("score").alias("score"))
    # Equal rows have equal answers, so they are one row with a count until the end.
    distinct = texts.groupBy(*keys, F.col(text_col).alias("_text")).agg(F.count(F.lit(1)).alias("_rows"))
    tokens = words(F.col("_text"))
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(longest)),
            lambda n: F.transform(
                _places(F.col("_t")),
                lambda i: F.struct(
                    i.alias("at"),
                    n.alias("size"),
                    F.when(i + n <= F.size("_t"), F.array_join(F.slice("_t", i + 1, n), " ")).alias("gram"),
                ),
            ),
        )
    )
    names = [*keys, "_text"]
    met = (
        distinct.select(*names, tokens.alias("_t"))
        .select(*names, F.explode(grams).alias("_g"))
        .select(*names, "_g.*")
        .where("gram is not null")
        .join(known, "gram")
        .groupBy(*names, "at")
        .agg(F.max(F.struct("size", "score")).alias("match"))
        .groupBy(*names)
        .agg(F.map_from_entries(F.collect_list(F.struct("at", "match"))).alias("_m"))
    )
    met = met.withColumnsRenamed({n: f"_met{i}" for i, n in enumerate(names)})
    same = [F.col(n).eqNullSafe(F.col(f"_met{i}")) for i, n in enumerate(names)]
    joined = distinct.join(met, reduce(lambda a, b: a & b, same), "left").select(
        *names, "_rows", "_m", tokens.alias("_t")
    )
    matches = F.transform(_places(F.col("_t")), lambda i: F.try_element_at("_m", i))
    polarity = _walked(F.col("_t"), F.col("_m_at"), modifiers)
    return (
        joined.withColumn("_m_at", matches)
        .select(*keys, polarity.alias("polarity"), F.explode(F.sequence(F.lit(1).cast("bigint"), "_rows")))
        .select(*keys, "polarity")
    )


def sentiment_polarity(
    frame: DataFrame, keys: list[str], text_col: str, lexicon: dict[str, float] | DataFrame
) -> DataFrame:
    """Mean polarity of the words of each text that are in the lexicon.

    `keys` identify a text and are carried through; null or empty texts have no
    row, texts without a known word get 0.0.

    A lexicon given as a dictionary of up to LEXICON_WORDS words is looked up inside the
    row, which neither moves nor grows; of words that differ in case only the last counts.
    Beyond that, or as a frame (`token`, `polarity`), it is joined without a hint and Spark
    shuffles it when it is too large to broadcast. The words of a text sit in one task, so
    map-side aggregation then leaves one small record per text to shuffle.
    """
    texts = frame.where(F.col(text_col).isNotNull() & (F.col(text_col) != ""))
    if isinstance(lexicon, dict) and len(lexicon) <= LEXICON_WORDS:
        return texts.select(*keys, _polarity_in_row(words(F.col(text_col)), lexicon).alias("polarity"))
    found = words(F.col(text_col))
    if isinstance(lexicon, dict):
        lexicon = lexicon_frame(frame.sparkSession, lexicon)
    tokens = texts.select(*keys, F.explode_outer(found).alias("token"))
    scored = tokens.join(lexicon, "token", "left")
    return (
        scored.groupBy(*keys)
        .agg(F.sum("polarity").alias("_sum"), F.count("polarity").alias("_hits"))
        .select(
            *keys,
            F.round(
                F.when(F.col("_hits") > 0, F.col("_sum").cast("double") / F.col("_hits"))
                .otherwise(F.lit(0.0)),
                2,
            ).alias("polarity"),
        )
    )
