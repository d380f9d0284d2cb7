import datetime as dt
import re
import time
from html import unescape

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmur.functions import scalars as S
from murmur.functions import text as T
from murmur.functions.fixed import AI_KEYWORDS, STOP_WORDS


@pytest.mark.parametrize(
    "data, expected",
    [
        ('{"ups": 5}', 5.0),
        ('{"ups": "7"}', 7.0),
        ('{"ups": null}', 0.0),
        ("{}", 0.0),
        ("nope", 0.0),
        (None, 0.0),
    ],
)
def test_json_field_or_default(one, data, expected):
    assert one(S.json_field_or_default(F.col("d"), "ups"), d=data) == expected


def test_json_field_is_null_for_bad_json(one):
    assert one(S.json_field(F.col("d"), "x"), d="nope") is None
    assert one(S.json_field(F.col("d"), "x"), d='{"x": "a"}') == "a"


@pytest.mark.parametrize(
    "text, expected",
    [
        (" 12.5 ", 12.5),
        ("1e3", 1000.0),
        ("-.5", -0.5),
        ("1d", None),
        ("0x10", None),
        ("", None),
        ("abc", None),
        (None, None),
    ],
)
def test_numeric_coerce(one, text, expected):
    assert one(S.numeric_coerce(F.col("t")), t=text) == expected


def test_epoch_seconds_floors(one):
    assert one(S.epoch_seconds(F.col("t")), t="1730419200.9") == 1730419200
    assert one(S.epoch_seconds(F.col("t")), t="1.7304192E9") == 1730419200
    assert one(S.epoch_seconds(F.col("t")), t="-0.5") == -1


def test_time_buckets(one):
    noon = 1730462400 + 59
    assert one(S.hour_bucket(F.col("t")), t=noon) == dt.datetime(2024, 11, 1, 12)
    assert one(S.day_bucket(F.col("t")), t=noon) == dt.date(2024, 11, 1)
    assert one(S.day_name(S.epoch_to_ts(F.col("t"))), t=noon) == "Friday"
    assert one(S.day_order(S.epoch_to_ts(F.col("t"))), t=noon) == 4


@pytest.mark.parametrize(
    "html, expected",
    [
        ('a<br>b <a class="quotelink" href="#p1">&gt;&gt;1</a>', "ab"),
        ('<A HREF="#p1" CLASS="x quotelink">&gt;&gt;1</A>text', "text"),
        ('<a class="other">kept</a>', "kept"),
        ("it&#039;s &quot;x&quot; &amp; y", "it's \"x\" & y"),
        ("&amp;gt;green", "green"),
        ("a&amp;lt;b", "a b"),
        ("&gt;green text", "green text"),
        ("<script>var a='<b>';</script>x<style>p{}</style><!-- c -->y", "xy"),
        ("  a   b \n\n \t c d  ", "a b\nc d"),
        ("caf&eacute; &copy; &#8217; &#x1F600; &#146;", "café © ’ 😀 ’"),
        ("AT&T &unknownname; &", "AT&T &unknownname; &"),
        ("&#0; &#xD800;", "� �"),
        ("1 < 2 > 0", "1 2 0"),
        ('<a title="a>b" href=\'x>y\'>link</a>', "link"),
        ("<p don't>y it's <b class=x>z</b>", "y it's z"),
        ('<a href="open>text', "text"),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_html_text(one, html, expected):
    assert one(T.clean_html_text(F.col("h")), h=html) == expected


def test_clean_html_strips_another_element(one):
    html = '<div class="ad">buy</div><p>keep</p>'
    assert one(T.clean_html_text(F.col("h"), "div", "ad"), h=html) == "keep"


def test_tokenize_words(one):
    tokens = one(T.tokenize_words(F.col("t")), t="The cat's éa b_c Über x²y")
    assert tokens == ["cat", "b_c", "über", "x²y"]


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="aBéß_ 1-.,'\nthe²", max_size=30), min_size=1, max_size=20))
def test_tokenize_words_equals_regex(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r.i: r.w for r in frame.select("i", T.tokenize_words(F.col("t")).alias("w")).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"\b\w+\b", text.lower())
        assert found[i] == [w for w in words if w not in STOP_WORDS and len(w) > 2]


@settings(
    max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.lists(
            st.sampled_from(["&", "amp;", "lt;", "#65;", "#x41;", "#146;", "eacute;", "a", " ", ";"]),
            max_size=8,
        ).map("".join),
        min_size=1,
        max_size=20,
    )
)
def test_decode_entities_equals_unescape_on_closed_references(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r.i: r.d for r in frame.select("i", T.decode_entities(F.col("t")).alias("d")).collect()}
    for i, text in enumerate(texts):
        assert found[i] == unescape(text)


def test_keyword_terms_never_match_hyphens(one):
    assert one(T.keyword_terms(F.col("t")), t="fine-tuning GPT, gpt4 AI!") == ["gpt", "gpt", "ai"]
    assert "fine-tuning" in AI_KEYWORDS


@pytest.mark.parametrize(
    "response, expected",
    [
        ('{"class":"flag","confidence":"0.93"}', (0.93, "flag", "0.93")),
        ('{"class":"flag","confidence":0.935}', (0.935, "flag", None)),
        ('{"class":"flag","confidence":1e-1}', (0.1, "flag", "0.10")),
        ('{"class":"flag","confidence":"x"}', (0.0, "", "0.00")),
        ('{"class":"flag","confidence":null}', (0.0, "", "0.00")),
        ('{"class":"flag","confidence":{"a":1}}', (0.0, "", "0.00")),
        ('{"class":"normal"}', (0.0, "normal", "0.00")),
        ('{"class":null,"confidence":0.5}', (0.5, "None", "0.50")),
        ('{"confidence":0.5}', (0.5, "", "0.50")),
        ('{"confidence":true,"class":"flag"}', (1.0, "flag", "1.00")),
        ("[1]", (0.0, "", "0.00")),
        ('"text"', (0.0, "", "0.00")),
        ("{", (0.0, "", "0.00")),
        ("", (0.0, "", "0.00")),
        (None, (0.0, "", "0.00")),
    ],
)
def test_parse_moderation(one, response, expected):
    found = one(T.parse_moderation(F.col("r")), r=response)
    assert (found["score"], found["class"]) == expected[:2]
    if expected[2]:
        assert found["score_text"] == expected[2]


def test_moderation_flag_needs_more_than_the_threshold(one):
    flag = S.moderation_flag(F.col("label"), F.col("conf"))
    assert one(flag, label="flag", conf=0.91) is True
    assert one(flag, label="flag", conf=0.9) is False
    assert one(flag, label="normal", conf=0.99) is False


TEXTS = [(1, "good good BAD"), (2, "nothing here"), (3, ""), (4, None), (5, "bad?good")]


@pytest.mark.parametrize("as_frame", [False, True])
def test_sentiment_polarity(spark, as_frame):
    lexicon = {"good": 0.75, "Bad": -0.25}
    frame = spark.createDataFrame(TEXTS, "id int, t string")
    given_lexicon = T.lexicon_frame(spark, lexicon) if as_frame else lexicon
    rows = T.sentiment_polarity(frame, ["id"], "t", given_lexicon).collect()
    assert {r.id: r.polarity for r in rows} == {1: 0.42, 2: 0.0, 5: 0.25}


def test_node_size(one):
    size = S.node_size(F.col("v"), F.col("lo"), F.col("hi"))
    assert one(size, v=5.0, lo=0.0, hi=10.0) == 32.5
    assert one(size, v=5.0, lo=5.0, hi=5.0) == 30.0


def test_preview_and_relevance(one):
    assert one(S.preview(F.col("t")), t="x" * 300) == "x" * 200 + "..."
    assert one(S.relevance(F.col("d")), d=0.256) == 0.74


@pytest.mark.parametrize(
    "html, expected",
    [("it&apos;s", "it's"), ("a &amp b", "a & b"), ("x &copy y", "x \u00a9 y"), ("&copyright;", "&copyright;"),
     ("&CounterClockwiseContourIntegral;", "\u2233"), ("&fjlig;", "fj"), ("&nosuch;", "&nosuch;"), ("&hellip", "\u2026")],
)
def test_names_of_html_5(one, html, expected):
    assert one(T.clean_html_text(F.col("h")), h=html) == expected


def test_number_out_of_range_gives_the_default(one):
    assert one(S.json_field_or_default(F.col("d"), "ups", 0, "int"), d='{"ups":"3000000000"}') == 0


@pytest.mark.parametrize(
    "html",
    ["<script>" * 130_000, "<script>a" * 60_000 + "</script>x", "<!--" * 200_000, "<a class=quotelink>" * 50_000,
     "<style>b" * 100_000 + "</style>y", "<b " * 200_000],
)
def test_clean_html_takes_linear_time(one, html):
    """A megabyte of elements that nothing ends, each of which took a look through the rest."""
    begin = time.time()
    got = one(F.length(T.clean_html_text(F.col("h"))), h=html)
    assert got is not None and time.time() - begin < 20


@pytest.mark.parametrize(
    "html, expected",
    [
        ("a<script>x</script>b<script>y", "aby"),
        ("<script>" * 40 + "in</script>out<script>left", "outleft"),
        ("<!-- " * 40 + "-->x<!-- y", "x<!-- y".replace("<", "")),
        ("1 > 0 <b>and</b> 2 > 1 <", "1  0 and 2  1".replace("  ", " ")),
        ("no tags", "no tags"),
        ("x>", "x"),
    ],
)
def test_guarded_and_plain_removal_agree(one, html, expected):
    assert one(T.clean_html_text(F.col("h")), h=html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<title>und&amp</title><h1>Ende</h1>", "und&Ende"),
        ("<title>on &amp;&</title><h1>And&&</h1>", "on &&And&&"),
        ("&am<b>p</b> x", "&amp x"),
        ("caf&eacute<!-- c -->s", "caf\u00e9s"),
        ("a&<script>x</script>copy b<style>c</style>", "a&copy b"),
        ("&#6<i>5</i>", "\x065"),
        ("a<<!-- c -->b>d", "abd"),
        ("&lt<i>b</i>&gt;", "b"),
    ],
)
def test_no_reference_is_read_across_a_tag(one, html, expected):
    """Tags went first, and `&amp</b>x` was left as `&ampx`, `&</b>And` became one character."""
    for left_open in ("", " " + "<script>" * (T.FEW_OPENED + 1)):
        assert one(T.clean_html_text(F.col("h")), h=html + left_open) == expected
