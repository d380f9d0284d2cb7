"""URL verdicts from rules, and from trust and distrust spread over the links between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import stored

# Rules (host, path, verdict): a host stands for itself and its subdomains.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
DAMPING = 0.85
ROUNDS = 20
# Rounds between two written tables.
CUT = 5
# A page without a rule is blocked only where this share of the walks from its host ends at
# blocked hosts, however many hosts link to these.
BAD_SHARE = 0.4
# A host is a seed if rules decide more than this share of its pages in one way.
SEED_SHARE = 0.5


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty without ://."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of rule and verdict: the longest rule that fits, else null. A few fixed rules."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for where, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == where) | host.endswith(f".{where}")) & path.startswith(start)
        found = F.struct(F.lit(where + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found).otherwise(out)
    return out


def link_hosts(html: Column, host: Column) -> Column:
    """Hosts that a page links to, once for each link: absolute addresses and //host ones.

    Links without a host stay on the page's own host and say nothing about others.
    """
    pattern = r"(?is)<a\s[^>]*?href\s*=\s*[\"']?\s*((?:https?:)?//[^\"'\s>]*)"
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(1))
    hosts = F.transform(found, lambda u: host_of(F.concat(F.lit("x:"), F.regexp_replace(u, r"(?i)^https?:", ""))))
    return F.filter(hosts, lambda h: (h != "") & (h != host))


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, links between different hosts; counted in each task before the shuffle."""
    return (
        pages.select("host", F.explode(link_hosts(F.col("html"), F.col("host"))).alias("dst"))
        .where(F.col("host") != "")
        .groupBy(F.col("host").alias("src"), "dst")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def spread(
    edges: DataFrame,
    seeds: DataFrame,
    name: str,
    damping: float = DAMPING,
    rounds: int = ROUNDS,
    cut: int = CUT,
) -> DataFrame:
    """Personalised PageRank: host, score. `seeds` has every host with its seed weight.

    A host hands `damping` of its score to the hosts its edges (src, dst, links) lead to, by
    number of links; one without edges keeps that part. The rest comes from the seeds. A
    score is not scaled to a sum of one, so a lone host's score is its seed. Each round is
    one join and one aggregation over the edges; the scores are written every `cut` rounds.
    """
    out = edges.groupBy("src").agg(F.sum("links").alias("all"))
    shares = stored(
        edges.join(out, "src").select("src", "dst", (F.col("links") / F.col("all")).alias("share")),
        f"{name}-shares",
    )
    ends = seeds.join(out.select(F.col("src").alias("host")).distinct(), "host", "left_anti").select(
        "host", F.lit(True).alias("ends")
    )
    base = stored(
        seeds.join(ends, "host", "left").select("host", "seed", F.coalesce("ends", F.lit(False)).alias("ends")),
        f"{name}-seeds",
    )
    score = base.select("host", F.col("seed").alias("score"))
    if shares.isEmpty():
        return score
    for at in range(1, rounds + 1):
        flows = (
            score.join(shares, F.col("host") == F.col("src"))
            .groupBy(F.col("dst").alias("host"))
            .agg(F.sum(F.col("score") * F.col("share")).alias("got"))
        )
        score = (
            base.join(score, "host")
            .join(flows, "host", "left")
            .select(
                "host",
                (
                    (1 - damping) * F.col("seed")
                    + damping
                    * (F.coalesce("got", F.lit(0.0)) + F.when(F.col("ends"), F.col("score")).otherwise(0.0))
                ).alias("score"),
            )
        )
        if at % cut == 0 and at < rounds:
            score = stored(score, f"{name}-round")
    return score


def walk_share(
    edges: DataFrame,
    seeds: DataFrame,
    name: str,
    damping: float = DAMPING,
    rounds: int = ROUNDS,
    cut: int = CUT,
) -> DataFrame:
    """host, share: how much of the walks along the links from a host ends at a seed.

    A seed has 1, another host `damping` times the mean of the hosts that it links to, by
    number of links; so what a host has does not depend on how many others link there. The
    walk is followed backwards from the seeds, `rounds` links far.
    """
    out = edges.groupBy("src").agg(F.sum("links").alias("all"))
    shares = stored(
        edges.join(out, "src").select("src", "dst", (F.col("links") / F.col("all")).alias("share")),
        f"{name}-shares",
    )
    share = seeds.select("host", F.col("seed").alias("score"))
    if shares.isEmpty():
        return share.withColumnRenamed("score", "share")
    for at in range(1, rounds + 1):
        back = (
            shares.join(share.where("score > 0"), F.col("dst") == F.col("host"))
            .groupBy(F.col("src").alias("host"))
            .agg(F.sum(F.col("share") * F.col("score")).alias("got"))
        )
        share = seeds.join(back, "host", "left").select(
            "host",
            "seed",
            F.when(F.col("seed") > 0, 1.0).otherwise(damping * F.coalesce("got", F.lit(0.0))).alias("score"),
        )
        if at % cut == 0 and at < rounds:
            share = stored(share, f"{name}-round")
    return share.select("host", F.col("score").alias("share"))


def host_scores(pages: DataFrame, name: str = "links", **options) -> DataFrame:
    """host, trust, distrust, bad_share of every host that has a page or is linked to.

    `pages` has host, html and found (the rule struct). A host is a seed of trust (of
    distrust) if rules allow (block) most of its pages. Trust follows the links; distrust
    goes against them, from a blocked host to those that link to it.
    """

    def seed(verdict: str) -> Column:
        share = F.avg((F.coalesce(F.col("found.verdict"), F.lit("")) == verdict).cast("double"))
        return (share > SEED_SHARE).cast("double")

    edges = stored(host_edges(pages), f"{name}-edges")
    seeds = pages.groupBy("host").agg(seed("allow").alias("good"), seed("block").alias("bad"))
    linked = edges.select(F.col("dst").alias("host")).distinct()
    every = stored(
        linked.join(seeds, "host", "full_outer").select(
            "host", F.coalesce("good", F.lit(0.0)).alias("good"), F.coalesce("bad", F.lit(0.0)).alias("bad")
        ),
        f"{name}-hosts",
    )
    trust = spread(edges, every.select("host", F.col("good").alias("seed")), f"{name}-trust", **options)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    distrust = spread(back, every.select("host", F.col("bad").alias("seed")), f"{name}-distrust", **options)
    share = walk_share(edges, every.select("host", F.col("bad").alias("seed")), f"{name}-share", **options)
    return (
        trust.withColumnRenamed("score", "trust")
        .join(distrust.withColumnRenamed("score", "distrust"), "host")
        .join(share.withColumnRenamed("share", "bad_share"), "host")
    )


def judge_pages(pages: DataFrame, rules=RULES, **options) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every page.

    The longest fitting rule decides; without one the page's host does: blocked if its
    distrust exceeds its trust and at least BAD_SHARE of the walks along its links end at
    blocked hosts, else allowed. There is no least distrust: the distrust of a blocked host is
    divided among all that link to it, so any bound loses them when they are many. The share
    keeps hosts that have a bad link among many. A chain of hosts whose only links lead on to
    a blocked one is blocked up to five links away. Null urls and those without :// have empty host and path and share the host of
    empty name, which has no links. Null html has no links. Repeated rows are judged alike;
    other columns are not read. Hosts grow with the pages, so their scores are joined; a
    host with very many pages is pre-aggregated in each task, and its pages are split by the
    adaptive join.
    """
    judged = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        "html",
    ).withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    scores = host_scores(judged, **options)
    bad = (F.col("distrust") > F.col("trust")) & (F.col("bad_share") >= BAD_SHARE)
    by_host = F.when(bad, "block").otherwise("allow")
    return judged.drop("html").join(scores, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
