import re

import pytest
from pyspark.sql import functions as F

from murmur.llm import links as K


def python_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


URLS = [
    "http://A.Example.NET/en/x?y#z", "https://example.net/en", "http://x.net", "http://net/", "http://notexample.net/en/",
    "http://b.example.com/de/1", "http://b.example.com/fr/de/", "http://é.ORG/fr/", "http://org/fr/a#/", "x://y://z/fr/",
    "http://q.org?/fr/", "http://q.org#a", "no scheme", "", None, "http://", "http:///p", "http://e.example.com:80/de/",
    "http://a.org/fr/\nb", "://h/p",
]


def test_parts_and_rules(spark):
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("html", F.lit(None).cast("string"))
    got = {r.page_id: r for r in K.judge_pages(frame.withColumn("host", F.lit("x")).withColumn("found", F.lit(1))).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = python_parts(u)
        assert (got[i].host, got[i].path) == (host, path), u
        fits = [(w + p, v) for w, p, v in K.RULES if (host == w or host.endswith("." + w)) and path.startswith(p)]
        rule = max(fits, key=lambda r: len(r[0]), default=(None, None))
        assert got[i].rule == rule[0]
        if rule[0]:
            assert got[i].verdict == rule[1]


def brute(edges, seed, rounds):
    out = {}
    for s, d, n in edges:
        out.setdefault(s, []).append((d, n))
    score = dict(seed)
    for _ in range(rounds):
        new = {h: (1 - K.DAMPING) * seed[h] for h in seed}
        for h, x in score.items():
            if h not in out:
                new[h] += K.DAMPING * x
            else:
                total = sum(n for _, n in out[h])
                for d, n in out[h]:
                    new[d] += K.DAMPING * x * n / total
        score = new
    return score


def page(i, host, path, *to):
    anchors = "".join(f'<a class="k" href="{t}">t</a>' for t in to)
    return (i, f"http://{host}{path}", f"<html><a href='/local'>l</a>{anchors}</html>")


def test_trust_flows_along_and_distrust_against_links(spark):
    rows = [
        page(1, "a.org", "/fr/", "https://b.org/x", "//c.com/"),
        page(2, "b.org", "/x", "http://C.com/y", "http://c.com/z", "http://a.org/"),
        page(3, "bad.net", "/", "http://c.com/"),
        page(4, "farm.com", "/", "http://bad.net/", "http://bad.net/2"),
        page(5, "farm2.com", "/", "http://farm.com/"),
        page(6, "c.com", "/"),
        page(7, "lone.com", "/"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r for r in K.judge_pages(frame).collect()}
    hosts = list(got)
    edges = [("a.org", "b.org", 1), ("a.org", "c.com", 1), ("b.org", "c.com", 2), ("b.org", "a.org", 1),
             ("bad.net", "c.com", 1), ("farm.com", "bad.net", 2), ("farm2.com", "farm.com", 1)]
    good = brute(edges, {h: float(h == "a.org") for h in hosts}, K.ROUNDS)
    bad = brute([(d, s, n) for s, d, n in edges], {h: float(h == "bad.net") for h in hosts}, K.ROUNDS)
    for h in hosts:
        assert got[h].trust == pytest.approx(good[h]) and got[h].distrust == pytest.approx(bad[h])
    assert got["farm.com"].verdict == got["farm2.com"].verdict == "block"
    assert got["c.com"].verdict == got["b.org"].verdict == got["lone.com"].verdict == "allow"
    none = spark.createDataFrame([], frame.schema)
    assert K.judge_pages(none).collect() == []
    twice = K.judge_pages(frame.unionAll(frame.where("page_id = 6"))).where("page_id = 6").collect()
    assert len(twice) == 2 and twice[0] == twice[1]


@pytest.mark.parametrize("linkers", [400])
def test_many_linkers_of_a_blocked_host_are_all_blocked(spark, linkers):
    rows = [page(0, "bad.net", "/")] + [page(i, f"f{i}.com", "/", "http://bad.net/") for i in range(1, linkers + 1)]
    rows += [page(1000, "behind.com", "/", "http://f1.com/"), page(1001, "other.com", "/", "http://fine.com/")]
    got = {r.host: r.verdict for r in K.judge_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), rounds=3).collect()}
    assert {h for h, v in got.items() if v == "allow"} == {"other.com"}


def plain_share(edges, seeds, rounds):
    out = {}
    for s, d, n in edges:
        out.setdefault(s, []).append((d, n))
    share = dict(seeds)
    for _ in range(rounds):
        share = {
            h: 1.0 if seeds[h] else K.DAMPING * sum(share[d] * n for d, n in out.get(h, [])) / max(sum(n for _, n in out.get(h, [])), 1)
            for h in seeds
        }
    return share


def test_shares_of_walks(spark):
    import random

    rng = random.Random(2)
    hosts = [f"h{i}" for i in range(40)]
    edges = list({(a, b): (a, b, rng.randint(1, 4)) for a, b in [rng.sample(hosts, 2) for _ in range(90)]}.values())
    seeds = {h: float(rng.random() < 0.15) for h in hosts}
    frame = spark.createDataFrame(edges, "src string, dst string, links long")
    got = K.walk_share(frame, spark.createDataFrame(list(seeds.items()), "host string, seed double"), "t", rounds=6)
    want = plain_share(edges, seeds, 6)
    assert {r.host: pytest.approx(r.share) for r in got.collect()} == want


def test_a_bad_link_among_many_blocks_nobody(spark):
    """Whatever the size of the graph: few bad links are allowed, chains to a blocked host not."""
    clean = [f"http://clean{i}.com/" for i in range(1000)]
    rows = [
        page(0, "bad.net", "/"),
        page(1, "big.com", "/", "http://bad.net/", *clean),
        page(2, "fan.com", "/", "http://big.com/"),
        page(3, "one.com", "/", "http://bad.net/"),
        page(4, "two.com", "/", "http://one.com/"),
        page(5, "half.com", "/", "http://bad.net/", "http://clean1.com/"),
        page(6, "third.com", "/", "http://bad.net/", "http://clean1.com/", "http://clean2.com/"),
    ]
    got = {r.host: r for r in K.judge_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), rounds=6).collect()}
    assert {h for h, r in got.items() if r.verdict == "block"} == {"bad.net", "one.com", "two.com", "half.com"}
