import random

import pytest
import regex
from pyspark.sql import functions as F

from murmur.functions import text as T
from murmur.functions.fixed import WORD_PATTERN

LEXICON = {"good": 0.7, "Bad": -0.65, "great": 0.8, "not bad": 0.2, "new york city": 0.05, "awful": -1, "city": 0.01, "GREAT": 0.9}
MODIFIERS = T.Modifiers(("not", "never"), {"very": 1.3, "slightly": 0.5, "extremely": 2}, 1)


def words_of(text):
    return regex.findall(WORD_PATTERN, text.lower())


def plain(text, lexicon=LEXICON, modifiers=MODIFIERS, longest=3):
    """The walk in Python, on fractions of whole numbers."""
    entries = {" ".join(words_of(k)): round(v * 10_000) for k, v in lexicon.items()}
    strong = {k: round(v * 100) for k, v in modifiers.intensities.items()}
    tokens, at, total, hits = words_of(text), 0, 0, 0
    factor, negated, idle = 100, False, 0
    while at < len(tokens):
        for size in range(min(longest, len(tokens) - at), 0, -1):
            gram = " ".join(tokens[at : at + size])
            if gram in entries:
                total += max(-2_000_000, min(2_000_000, entries[gram] * factor * (-1 if negated else 2)))
                hits, at = hits + 1, at + size
                factor, negated, idle = 100, False, 0
                break
        else:
            word, at = tokens[at], at + 1
            if word in modifiers.negations:
                negated, idle = True, 0
            elif word in strong:
                factor, idle = min(factor * strong[word] // 100, 10_000), 0
            elif idle < modifiers.reach:
                idle += 1
            else:
                factor, negated, idle = 100, False, 0
    return total / (2_000_000 * hits) if hits else 0.0


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["good", "Bad", "great", "not", "never", "very", "slightly", "extremely", "new", "york", "city", "the", "a", "thing", "awful"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 14))) + rng.choice(["", ".", "!\n"]) for _ in range(n)]


def answers(frame):
    return sorted(((r.id, r.polarity) for r in frame.collect()), key=str)


@pytest.mark.parametrize("reach", [0, 1, 3])
def test_dictionary_frame_and_python_agree(spark, reach):
    modifiers = T.Modifiers(MODIFIERS.negations, MODIFIERS.intensities, reach)
    rows = [(i, t) for i, t in enumerate(texts(300))] + [(7, "good city"), (7, "good city"), (8, None), (None, "very bad")]
    frame = spark.createDataFrame(rows, "id long, body string")
    got = answers(T.modified_polarity(frame, ["id"], "body", LEXICON, modifiers))
    assert [i for i, _ in got] == [i for i, _ in sorted(((i, t) for i, t in rows if t), key=lambda r: str(r[0]))] or len(got) == sum(bool(t) for _, t in rows)
    want = {(i, t): plain(t, modifiers=modifiers) for i, t in rows if t}
    by_id = {}
    for (i, _), v in want.items():
        by_id.setdefault(i, []).append(v)
    for i, p in got:
        assert any(abs(p - v) <= 0.005 + 1e-9 for v in by_id[i])
    lexicon = spark.createDataFrame([("good", 0.7), ("bad", -0.65), ("great", 0.9), ("great", 0.8), ("not  BAD", 0.2), ("new york city", 0.05), ("awful", -1.0), ("city", 0.01), ("?!", 0.4)], "token string, polarity double")
    assert answers(T.modified_polarity(frame, ["id"], "body", lexicon, modifiers)) == got


def test_large_dictionaries_are_joined(spark, monkeypatch):
    frame = spark.createDataFrame(list(enumerate(texts(60, 4))), "id long, body string")
    want = answers(T.modified_polarity(frame, ["id"], "body", LEXICON, MODIFIERS))
    monkeypatch.setattr(T, "LEXICON_WORDS", 2)
    assert answers(T.modified_polarity(frame, ["id"], "body", LEXICON, MODIFIERS)) == want


@pytest.mark.parametrize(
    "text, expected",
    [
        ("good", 0.7),
        ("very good", 0.91),
        ("not good", -0.35),
        ("not a good", -0.35),
        ("not a new good", 0.7),
        ("not very good", -0.46),
        ("not bad", 0.2),
        ("never bad", 0.33),
        ("extremely awful", -1.0),
        ("extremely extremely great", 1.0),
        ("good New  York City", 0.38),
        ("nothing known", 0.0),
        ("?!", 0.0),
    ],
)
def test_cases(spark, text, expected):
    frame = spark.createDataFrame([(1, text)], "id long, body string")
    ((_, got),) = answers(T.modified_polarity(frame, ["id"], "body", LEXICON, MODIFIERS))
    assert got == expected


def test_without_modifiers_it_is_the_mean(spark):
    words = {"good": 0.7, "bad": -0.65, "great": 0.8}
    frame = spark.createDataFrame(list(enumerate(texts(100, 9))), "id long, body string").where(F.col("body") != "")
    assert answers(T.modified_polarity(frame, ["id"], "body", words)) == answers(T.sentiment_polarity(frame, ["id"], "body", words))


def test_words_that_differ_in_case_count_once_either_way(spark, monkeypatch):
    lexicon = {"Good": 0.1, "good": 0.5, "GOOD": 0.3}
    frame = spark.createDataFrame([(1, "good Good"), (2, "x")], "id long, body string")
    in_row = answers(T.sentiment_polarity(frame, ["id"], "body", lexicon))
    monkeypatch.setattr(T, "LEXICON_WORDS", 0)
    assert answers(T.sentiment_polarity(frame, ["id"], "body", lexicon)) == in_row == [(1, 0.3), (2, 0.0)]
