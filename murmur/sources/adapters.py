"""The provided tables seen as forum posts, comments and payloads.

Each view has the same rows as the SQL of the same name in ``VIEWS``. Views are
cheap projections: scans stay column-pruned, and `window` adds a filter on the
stored date so that a time range reaches the parquet reader.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.functions.scalars import json_field
from murmur.session import use_utc

# Given schemas spare a job that would read file footers before each query.
TABLES = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}

DAY = 86400
JAN_2024 = 1704067200

VIEWS = {
    "posts": """
        select cast(o_orderkey as varchar) post_id, o_orderpriority subreddit,
               'u' || o_custkey author, cast(floor(o_totalprice / 1000) as int) votes,
               cast(floor(epoch(o_orderdate)) as bigint) + (o_orderkey * 7919) % 86400 created,
               o_orderstatus status, p_name cleaned_title, p_type cleaned_text
        from orders left join part on p_partkey = o_custkey""",
    "comments": """
        select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         cast(round(l_extendedprice * 100) as bigint)) id,
               cast(l_orderkey as varchar) post_id, 'u' || l_suppkey author,
               (l_quantity + 14) / 64 mod_score,
               case when l_returnflag = 'R' then 'flag' else 'normal' end class,
               cast(floor(epoch(l_shipdate)) as bigint)
                   + (l_orderkey * 7919 + l_linenumber * 613) % 86400 created
        from lineitem""",
    "chan_posts": """
        select event_id post_number, user_id thread_number, event_type board,
               cast(floor(epoch(ts)) as bigint) created, props data,
               try_cast(json_extract_string(props, '$.k') as int) replies,
               case when value < 10 then 0 else user_id end resto,
               least(floor(value), 128) / 128 mod_score,
               case when value > 30 then 'flag' else 'normal' end class
        from events""",
    "doc_posts": """
        select cast(doc_id as varchar) post_id, lang subreddit, source board,
               1704067200 + (doc_id * 7919) % 2592000 created,
               source || ' ' || lang cleaned_title, text cleaned_text
        from documents""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, *keys: str) -> DataFrame:
    """A table whose rows take long to parse, spread over the cores if its scan has fewer tasks.

    A small table is one file with one row group and would be worked on by a
    single core. Tables of many files keep their own partitions and are not
    shuffled.
    """
    frame = table(spark, folder, name)
    cores = spark.sparkContext.defaultParallelism
    if frame.rdd.getNumPartitions() < cores:
        frame = frame.repartition(cores, *keys)
    return frame


def _epoch(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp"))


def _days_around(column: str, window: tuple[int, int] | None) -> Column:
    """Stored dates are midnights at most a day before the derived second."""
    if window is None:
        return F.lit(True)

    def at(seconds: int) -> Column:
        moment = datetime(1970, 1, 1) + timedelta(seconds=seconds)
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")

    return (F.col(column) >= at(window[0] - DAY)) & (F.col(column) <= at(window[1]))


def posts(
    spark: SparkSession,
    folder: str,
    text: bool = False,
    window: tuple[int, int] | None = None,
    spread: bool = False,
) -> DataFrame:
    """Orders as posts. `text` joins the part table for title and text."""
    orders = (
        spread_table(spark, folder, "orders", "o_orderkey")
        if spread
        else table(spark, folder, "orders").where(_days_around("o_orderdate", window))
    )
    key = F.col("o_orderkey")
    out = orders.select(
        key.cast("string").alias("post_id"),
        F.col("o_orderpriority").alias("subreddit"),
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("author"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("votes"),
        (_epoch(F.col("o_orderdate")) + key * 7919 % DAY).alias("created"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("_title"),
    )
    if not text:
        return out.drop("_title")
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("_title"),
        F.col("p_name").alias("cleaned_title"),
        F.col("p_type").alias("cleaned_text"),
    )
    return out.join(parts, "_title", "left").drop("_title")


def posts_json(spark: SparkSession, folder: str) -> DataFrame:
    """Posts as stored by a crawler: keys and one JSON column.

    `ups` is a number, malformed or absent by order status; `created` is text
    with a fraction.
    """
    ups = F.when(F.col("status") == "F", F.col("votes").cast("string")).when(
        F.col("status") == "O", F.lit("n/a")
    )
    data = F.to_json(
        F.struct(
            F.col("post_id").alias("id"),
            "author",
            F.col("votes").alias("score"),
            ups.alias("ups"),
            F.concat(F.col("created").cast("string"), F.lit(".5")).alias("created"),
        )
    )
    return posts(spark, folder, spread=True).select("post_id", "subreddit", data.alias("data"))


def comments(
    spark: SparkSession, folder: str, window: tuple[int, int] | None = None
) -> DataFrame:
    lines = table(spark, folder, "lineitem").where(_days_around("l_shipdate", window))
    order, number = F.col("l_orderkey"), F.col("l_linenumber")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return lines.select(
        F.concat_ws(
            "-",
            *[
                c.cast("string")
                for c in (order, number, F.col("l_partkey"), F.col("l_suppkey"), cents)
            ],
        ).alias("id"),
        order.cast("string").alias("post_id"),
        F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("author"),
        ((F.col("l_quantity") + 14) / 64).alias("mod_score"),
        F.when(F.col("l_returnflag") == "R", "flag").otherwise("normal").alias("class"),
        (_epoch(F.col("l_shipdate")) + (order * 7919 + number * 613) % DAY).alias("created"),
    )


def chan_posts(
    spark: SparkSession, folder: str, window: tuple[int, int] | None = None
) -> DataFrame:
    events = table(spark, folder, "events").where(_days_around("ts", window))
    value = F.col("value")
    return events.select(
        F.col("event_id").alias("post_number"),
        F.col("user_id").alias("thread_number"),
        F.col("event_type").alias("board"),
        _epoch(F.col("ts")).alias("created"),
        F.col("props").alias("data"),
        json_field(F.col("props"), "k").try_cast("int").alias("replies"),
        F.when(value < 10, F.lit(0)).otherwise(F.col("user_id")).alias("resto"),
        (F.least(F.floor(value), F.lit(128)) / F.lit(128)).alias("mod_score"),
        F.when(value > 30, "flag").otherwise("normal").alias("class"),
    )


def doc_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as posts of January 2024."""
    return spread_table(spark, folder, "documents", "doc_id").select(
        F.col("doc_id").cast("string").alias("post_id"),
        F.col("lang").alias("subreddit"),
        F.col("source").alias("board"),
        (F.lit(JAN_2024) + F.col("doc_id") * 7919 % 2592000).alias("created"),
        F.concat_ws(" ", "source", "lang").alias("cleaned_title"),
        F.col("text").alias("cleaned_text"),
    )


def catalog_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as a small catalog of two pages."""
    payload = F.concat(
        F.lit('[{"page":1,"threads":[{"no":'),
        F.col("user_id").cast("string"),
        F.lit('}]},{"page":2,"threads":[{"no":'),
        F.col("event_id").cast("string"),
        F.lit("}]}]"),
    )
    return table(spark, folder, "events").select(
        F.col("event_type").alias("board"),
        _epoch(F.col("ts")).alias("snapshot_at"),
        payload.alias("payload"),
    )


def thread_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Each page as a thread: the page is the first post, the second has no text."""
    number = F.col("page_id")

    def post(no: Column, com: Column) -> Column:
        return F.struct(
            no.alias("no"), (F.lit(JAN_2024) + number * 60).alias("time"), com.alias("com")
        )

    body = F.array(
        post(number * 2, F.col("html")), post(number * 2 + 1, F.lit(None).cast("string"))
    )
    return spread_table(spark, folder, "pages", "page_id").select(
        F.regexp_extract("url", "^https?://([^/]+)/", 1).alias("board"),
        number.alias("thread_number"),
        F.to_json(F.struct(body.alias("posts"))).alias("payload"),
    )


def listing_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation turn as a comment listing: one comment, two named ids."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    comment_id = F.concat_ws("-", conv, turn)
    member = "struct<id:string,body:string,children:array<string>>"

    def child(kind: str, data: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), data.cast(member).alias("data"))

    nothing = F.lit(None).cast("string")
    children = F.array(
        child("t1", F.struct(comment_id, F.col("text"), F.lit(None).cast("array<string>"))),
        child(
            "more",
            F.struct(nothing, nothing, F.array(F.concat(conv, F.lit("-x")), comment_id)),
        ),
    )
    listing = F.struct(F.struct(children.alias("children")).alias("data"))
    return table(spark, folder, "conversations").select(
        F.col("role").alias("subreddit"),
        conv.alias("post_id"),
        F.col("turn").alias("fetched_at"),
        F.to_json(listing).alias("payload"),
    )


def comment_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation turn as a tree: the turn, a reply per line, and under each
    line a reply that quotes it."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    root_id = F.concat_ws("-", conv, turn)

    def replies(children: Column) -> Column:
        return F.struct(F.struct(children.alias("children")).alias("data"))

    def line_node(line: Column, i: Column) -> Column:
        line_id = F.concat_ws("-", root_id, i.cast("string"))
        echo = F.struct(
            F.concat(line_id, F.lit("e")).alias("id"),
            line_id.alias("parent_id"),
            F.concat(F.lit("so: "), line).alias("body"),
            F.lit("").alias("replies"),
        )
        data = F.struct(
            line_id.alias("id"),
            root_id.alias("parent_id"),
            line.alias("body"),
            replies(F.array(F.struct(F.lit("t1").alias("kind"), echo.alias("data")))).alias(
                "replies"
            ),
        )
        return F.struct(F.lit("t1").alias("kind"), data.alias("data"))

    root = F.struct(
        root_id.alias("id"),
        F.col("role").alias("body"),
        replies(F.transform(F.split("text", "\n"), line_node)).alias("replies"),
    )
    return spread_table(spark, folder, "conversations", "conv_id", "turn").select(
        conv.alias("post_id"), F.to_json(root).alias("payload")
    )


def moderation_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Each line item as a moderation response, good and bad ones alike."""
    number = F.col("l_linenumber")
    label = F.when(F.col("l_returnflag") == "R", "flag").otherwise("normal")
    confidence = F.concat(F.lit("0."), (F.col("l_quantity").cast("int") + 49).cast("string"))

    def record(value: Column) -> Column:
        return F.concat(
            F.lit('{"class":"'), label, F.lit('","confidence":'), value, F.lit("}")
        )

    response = (
        F.when(number == 7, record(F.lit('"x"')))
        .when(number == 6, F.lit("not json"))
        .when(number == 5, record(F.lit("null")))
        .when(number == 4, F.concat(F.lit('{"class":"'), label, F.lit('"}')))
        .when(number == 3, record(F.concat(F.lit('"'), confidence, F.lit('"'))))
        .otherwise(record(confidence))
    )
    return spread_table(spark, folder, "lineitem", "l_orderkey", "l_linenumber").select(
        F.col("l_orderkey").cast("string").alias("post_id"), number, response.alias("response")
    )


def epoch_of(year: int, month: int, day: int) -> int:
    return int(datetime(year, month, day, tzinfo=timezone.utc).timestamp())
