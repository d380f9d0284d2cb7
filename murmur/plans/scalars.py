"""Queries for column functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.functions import scalars as S
from murmur.functions import text as T
from murmur.operators import network, retrieval
from murmur.operators.joins import interaction_counts, posts_left_join_comments
from murmur.plans.registry import query
from murmur.sources import adapters

# Words that occur in the provided prose, with polarities.
LEXICON = {"that": 0.5, "with": 0.25, "from": -0.5, "this": -0.25, "que": 0.75, "der": -0.75}
KEYWORDS = ["that", "with", "from", "this", "des", "und", "fine-tuning"]
LEXICON_SQL = ", ".join(f"('{w}', cast({p} as decimal(6,4)))" for w, p in LEXICON.items())
KEYWORDS_SQL = ", ".join(f"'{w}'" for w in KEYWORDS)
STOP_SQL = ", ".join(f"'{w}'" for w in T.STOP_WORDS)

TOKENS_SQL = f"""
select post_id, token from (
  select post_id, unnest(regexp_extract_all(lower(cleaned_text), '[\\p{{L}}\\p{{N}}_]+')) token
  from doc_posts)
where length(token) > 2 and token not in ({STOP_SQL})"""

TERMS_SQL = f"""
select post_id, term from (
  select post_id, unnest(regexp_extract_all(lower(cleaned_text), '[a-z]+')) term
  from doc_posts where cleaned_text is not null and cleaned_text <> '')
where term in ({KEYWORDS_SQL})"""

POLARITY_SQL = f"""
lexicon(token, polarity) as (values {LEXICON_SQL}),
tokens as (
  select post_id, unnest(regexp_extract_all(lower(cleaned_text), '[\\p{{L}}\\p{{N}}_]+')) token
  from doc_posts),
sums as (
  select post_id, cast(sum(polarity) as double) s, count(*) n
  from tokens join lexicon using (token) group by post_id),
scored as (
  select d.post_id, d.created,
         coalesce(cast(round(cast(s / n as decimal(18,10)), 2) as double), 0.0) polarity
  from doc_posts d left join sums using (post_id)
  where d.cleaned_text is not null and d.cleaned_text <> '')"""


@query("select event_id, json_extract_string(props, '$.k') k, cast(null as varchar) missing from events")
def json_field(spark, folder):
    events = adapters.table(spark, folder, "events")
    return events.select(
        "event_id",
        S.json_field(F.col("props"), "k").alias("k"),
        S.json_field(F.col("props"), "other").alias("missing"),
    )


@query("""
select post_id, cast(case when status = 'F' then votes else 0 end as double) ups from posts
""")
def json_field_or_default(spark, folder):
    posts = adapters.posts_json(spark, folder)
    return posts.select("post_id", S.json_field_or_default(F.col("data"), "ups").alias("ups"))


@query("""
select o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) as double) level,
       try_cast(o_orderpriority as double) whole from orders
""")
def numeric_coerce(spark, folder):
    priority = F.col("o_orderpriority")
    return adapters.table(spark, folder, "orders").select(
        "o_orderkey",
        S.numeric_coerce(F.split(priority, "-")[0]).alias("level"),
        S.numeric_coerce(priority).alias("whole"),
    )


@query("select post_id, created from posts")
def epoch_seconds(spark, folder):
    posts = adapters.posts_json(spark, folder)
    return posts.select(
        "post_id", S.epoch_seconds(S.json_field(F.col("data"), "created")).alias("created")
    )


@query("select post_id, make_timestamp(created * 1000000) ts from posts")
def epoch_to_ts(spark, folder):
    return adapters.posts(spark, folder).select(
        "post_id", S.epoch_to_ts(F.col("created")).cast("timestamp_ntz").alias("ts")
    )


@query("select post_id, date_trunc('hour', make_timestamp(created * 1000000)) \"hour\" from posts")
def hour_bucket(spark, folder):
    return adapters.posts(spark, folder).select(
        "post_id", S.hour_bucket(F.col("created")).alias("hour")
    )


@query("select post_id, cast(make_timestamp(created * 1000000) as date) \"day\" from posts")
def day_bucket(spark, folder):
    return adapters.posts(spark, folder).select(
        "post_id", S.day_bucket(F.col("created")).alias("day")
    )


@query("select post_id, cast(hour(make_timestamp(created * 1000000)) as int) \"hour\" from posts")
def hour_of_day(spark, folder):
    return adapters.posts(spark, folder).select(
        "post_id", S.hour_of_day(S.epoch_to_ts(F.col("created"))).alias("hour")
    )


@query("""
select post_id, dayname(make_timestamp(created * 1000000)) "day",
       cast(isodow(make_timestamp(created * 1000000)) - 1 as int) day_order from posts
""")
def day_name(spark, folder):
    ts = S.epoch_to_ts(F.col("created"))
    return adapters.posts(spark, folder).select(
        "post_id", S.day_name(ts).alias("day"), S.day_order(ts).alias("day_order")
    )


@query(r"""
with a as (select page_id, regexp_replace(html, '<script[^>]*>.*?</script\s*>', '', 'gis') t from pages),
b as (select page_id, regexp_replace(t, '<style[^>]*>.*?</style\s*>', '', 'gis') t from a),
c as (select page_id, regexp_replace(t, '<!--.*?-->', '', 'gs') t from b),
d as (select page_id, regexp_replace(t, '<div class="ad">.*?</div\s*>', '', 'gis') t from c),
e as (select page_id, regexp_replace(t, '</?[A-Za-z][^>]*>|<[!?][^>]*>', '', 'g') t from d),
f as (select page_id, replace(replace(replace(replace(t, '&middot;', chr(183)), '&copy;', chr(169)),
             '&quot;', '"'), '&amp;', '&') t from e),
g as (select page_id, replace(replace(replace(replace(replace(replace(replace(t, '&gt;', ''),
             '&lt;', ' '), '&amp;', '&'), '&#039;', ''''), '&quot;', '"'), '>', ''), '<', '') t from f)
select page_id, array_to_string(list_filter(list_transform(string_split(t, chr(10)),
         lambda x: trim(regexp_replace(x, '[\s\x0b\x{00a0}]+', ' ', 'g'))),
         lambda x: x <> ''), chr(10)) cleaned
from g
""")
def clean_html_text(spark, folder):
    pages = adapters.spread_table(spark, folder, "pages", "page_id")
    return pages.select(
        "page_id", T.clean_html_text(F.col("html"), "div", "ad").alias("cleaned")
    )


@query(f"with tokens as ({TOKENS_SQL}) select post_id, token, count(*) n from tokens group by all")
def tokenize_words(spark, folder):
    docs = adapters.doc_posts(spark, folder)
    tokens = docs.select(
        "post_id", F.explode(T.tokenize_words(F.col("cleaned_text"))).alias("token")
    )
    return tokens.groupBy("post_id", "token").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
with terms as ({TERMS_SQL}) select post_id, string_agg(term, ' ' order by term) terms
from terms group by all
""")
def keyword_terms(spark, folder):
    docs = adapters.doc_posts(spark, folder)
    terms = F.array_sort(T.keyword_terms(F.col("cleaned_text"), KEYWORDS))
    return docs.select("post_id", F.array_join(terms, " ").alias("terms")).where("terms <> ''")


@query("""
with r as (
  select cast(l_orderkey as varchar) post_id, l_linenumber, l_linenumber between 5 and 7 bad,
         case when l_linenumber >= 4 then 0.0 else (l_quantity + 49) / 100 end score,
         case when l_returnflag = 'R' then 'flag' else 'normal' end class
  from lineitem)
select post_id, l_linenumber, cast(score as double) score,
       case when bad then '' else class end class, printf('%.2f', cast(score as double)) score_text
from r
""")
def parse_moderation(spark, folder):
    responses = adapters.moderation_responses(spark, folder)
    return responses.select(
        "post_id", "l_linenumber", T.parse_moderation(F.col("response")).alias("m")
    ).select("post_id", "l_linenumber", "m.*")


@query("""
select id, mod_score, class from comments where class = 'flag' and mod_score > 0.9
""")
def moderation_flag(spark, folder):
    comments = adapters.comments(spark, folder)
    return comments.where(S.moderation_flag(F.col("class"), F.col("mod_score"))).select(
        "id", "mod_score", "class"
    )


@query(f"with {POLARITY_SQL} select post_id, polarity from scored")
def sentiment_polarity(spark, folder):
    return T.sentiment_polarity(
        adapters.doc_posts(spark, folder), ["post_id"], "cleaned_text", LEXICON
    )


@query("""
select 'doc_' || post_id id, cleaned_title || chr(10) || cleaned_text document,
       subreddit, post_id, 'prose' topic from doc_posts
""")
def compose_document(spark, folder):
    docs = retrieval.compose_document(adapters.doc_posts(spark, folder), "prose")
    return docs.select("id", "document", "metadata.*")


@query("""
select post_id, 0.4::double * votes + 0.3::double * s + 15.0::double * n engagement_score
from (select post_id, votes, coalesce(sum(c.mod_score), 0) s, count(c.id) n
      from posts left join comments c using (post_id) group by 1, 2)
""")
def engagement_score(spark, folder):
    joined = posts_left_join_comments(
        adapters.posts(spark, folder), adapters.comments(spark, folder)
    )
    score = S.engagement_score(
        F.col("votes"), F.coalesce("score_sum", F.lit(0.0)), F.col("comment_count")
    )
    return joined.select("post_id", score.alias("engagement_score"))


@query("""
with i as (
  select p.author pa, c.author ca, p.votes, c.mod_score
  from posts p join comments c using (post_id)
  where p.author not in ('u0', 'u1') and c.author not in ('u0', 'u1')),
u as (
  select "user", sum(votes) v from (
    select pa "user", votes v0, votes from i union all select ca, 0, 0 from i) group by 1)
select "user", cast(v as bigint) post_score,
       case when max(v) over () = min(v) over () then 30.0 else
         round(20 + cast(v - min(v) over () as double) / (max(v) over () - min(v) over ()) * 25, 6)
       end node_size from u
""")
def scale_min_max(spark, folder):
    interactions = interaction_counts(
        adapters.posts(spark, folder), adapters.comments(spark, folder), ["u0", "u1"]
    )
    users = network.user_activity(interactions).select("user", "post_score")
    return network.scale_min_max(users, "post_score").withColumn(
        "node_size", F.round("node_size", 6)
    )
