"""Forum API payloads to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions.scalars import epoch_seconds, json_field
from murmur.functions.text import clean_html_text


def explode_catalog_threads(
    catalogs: DataFrame, keys: list[str], payload_col: str = "payload"
) -> DataFrame:
    """Catalog (pages of threads) to one row per thread number."""
    pages = F.from_json(F.col(payload_col), "array<struct<threads:array<struct<no:bigint>>>>")
    return catalogs.select(*keys, F.explode(pages).alias("_page")).select(
        *keys, F.explode("_page.threads.no").alias("thread_number")
    )


def explode_thread_posts(
    threads: DataFrame, keys: list[str], payload_col: str = "payload", clean: bool = True
) -> DataFrame:
    """Thread payload to posts. A post without `com` has an empty text.

    `keys` are carried through, usually board and thread number. All boards give
    the same columns. With `clean`, `cleaned_text` is the readable text of `com`.
    """
    posts = F.from_json(F.col(payload_col), "struct<posts:array<string>>")["posts"]
    rows = threads.select(*keys, F.explode(posts).alias("data"))
    record = F.from_json("data", "no string, time string, com string")
    out = rows.select(*keys, "data", record.alias("_post")).select(
        *keys,
        F.col("_post.no").try_cast("bigint").alias("post_number"),
        epoch_seconds(F.col("_post.time")).alias("created_at"),
        F.coalesce("_post.com", F.lit("")).alias("com"),
        "data",
    )
    return out.withColumn("cleaned_text", clean_html_text(F.col("com"))) if clean else out


def _children(listings: DataFrame, keys: list[str], payload_col: str) -> DataFrame:
    schema = "struct<data:struct<children:array<struct<kind:string,data:string>>>>"
    children = F.from_json(F.col(payload_col), schema)["data"]["children"]
    return listings.select(*keys, F.posexplode(children).alias("pos", "_child")).select(
        *keys, "pos", F.col("_child.kind").alias("kind"), F.col("_child.data").alias("data")
    )


def explode_listing(
    listings: DataFrame, keys: list[str], kind: str = "t1", payload_col: str = "payload"
) -> DataFrame:
    """Children of one kind as rows: keys, `pos` in the listing, id, JSON `data`.

    ``t1`` are comments and ``t3`` posts.
    """
    rows = _children(listings, keys, payload_col).where(F.col("kind") == kind)
    return rows.select(*keys, "pos", json_field(F.col("data"), "id").alias("id"), "data")


def listing_more_ids(
    listings: DataFrame, keys: list[str], payload_col: str = "payload"
) -> DataFrame:
    """Ids the listing only names (kind ``more``), once each."""
    more = _children(listings, keys, payload_col).where(F.col("kind") == "more")
    ids = F.from_json(json_field(F.col("data"), "children"), "array<string>")
    return more.select(*keys, F.explode(ids).alias("id")).distinct()

