"""Hosts, paths and rules against a plain reading; features; trees on labelled URLs."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import queries, urls

URLS = [
    "http://WWW.Example.COM/en/1", "https://example.com/en/", "http://a.net/es/x?u=://y/z",
    "http://net/fr/", "http://xnet/fr/", "example.com/en/", "", None, "x://", "a://b://c/d",
    "http://com", "http://com/", "https://m.example.com/EN/1#t", "http://h?q=/p", "http://h#f/p",
    "http://h/a\nb?c", "http://é.com/ü%20?a=1&b=2#c", "http://www.example.com.evil.org/en/",
    "http://" + "a" * 50_000 + ".org/" + "b/" * 20_000,
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:end], rest[end:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for verdict, name, begin in queries.RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(begin):
            if best is None or len(name + begin) > len(best[1]):
                best = (verdict, name + begin)
    return host, path, best


def test_rules(spark):
    rows = [(k, url, "clash", "clash") for k, url in enumerate([*URLS, URLS[0]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    model = urls.fit(pages.limit(0).withColumn("label", F.lit(1)))
    judged = {r.page_id: r for r in urls.judge(pages, queries.RULES, model).collect()}
    assert len(judged) == len(rows)
    for k, url, *_ in rows:
        host, path, best = plain(url)
        row = judged[k]
        assert (row.host, row.path) == (host, path)
        assert (row.rule, row.verdict) == ((best[1], best[0]) if best else (None, "allow"))


def test_features(spark):
    url = "https://A-b.example.org/x1/y%20?k=1&l=22#top"
    frame = spark.createDataFrame([(url,), (None,)], "url string")
    row, none = urls.lexical(frame, "url").collect()
    assert row["_length"] == len(url) and row["_depth"] == 2 and row["_labels"] == 3
    assert row["_parameters"] == 2 and row["_query_length"] == len("k=1&l=22")
    assert row["_digits"] == sum(c.isdigit() for c in url) / len(url)
    host = "a-b.example.org"
    bits = -sum(n / len(host) * math.log2(n / len(host)) for n in Counter(host).values())
    assert math.isclose(row["_host_entropy"], bits) and row["_suffix"] == "example.org"
    assert row["_secure"] == 1 and row["_escapes"] == 1 and row["_hyphens"] == 1
    assert none["_length"] == 0 and none["_host_entropy"] == 0


def test_trees_learn_from_labels(spark):
    rng = random.Random(3)
    rows = []
    for k in range(1200):
        bad = rng.random() < 0.4
        name = "".join(rng.choice("abcdefgh") for _ in range(6)) + ("-" * bad) + rng.choice("xyz")
        query = "?" + "&".join(f"p{i}={rng.randrange(10**6)}" for i in range(5)) if bad else ""
        rows.append((k, f"http://{name}.org/{rng.randrange(100)}{query}", int(bad)))
    pages = spark.createDataFrame(rows, "page_id long, url string, label int")
    awkward = spark.createDataFrame([(-1, None, 1), (-2, "http://a.org", None), (-3, "http://b.org", 7)], pages.schema)
    model = urls.fit(pages.where("page_id % 2 = 0").union(awkward), rounds=5)
    held = pages.where("page_id % 2 = 1")
    judged = urls.judge(held, (), model).join(held.select("page_id", "label"), "page_id").collect()
    right = sum((r.verdict == "block") == bool(r.label) for r in judged)
    assert right >= 0.95 * len(judged)
    assert all(0 <= r.score <= 1 for r in judged)
    assert urls.judge(held.limit(0), (), model).collect() == []


def test_sampled_classes_keep_their_shares(spark):
    rng = random.Random(5)
    rows = [
        (k, f"http://a.org/{rng.randrange(10**9)}", int(rng.random() < 0.2))
        for k in range(4000)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, label int")
    blocked = {}
    for cap in (300, 10_000):  # below and above both classes
        model = urls.fit(pages.where("page_id < 3000"), sample=cap, rounds=5, depth=2)
        judged = urls.judge(pages.where("page_id >= 3000"), (), model)
        blocked[cap] = judged.where("verdict = 'block'").count()
    assert blocked[10_000] <= 10 and blocked[300] <= 10, blocked


def test_every_suffix_has_its_share(spark):
    labelled = spark.range(24_000).select(  # 12,000 sites, every tenth of label 1
        F.concat(F.lit("http://s"), F.expr("id % 12000"), F.lit(".org/"), F.col("id")).alias("url"),
        F.expr("cast(id % 12000 % 10 = 0 AS int)").alias("label"),
    )
    _, shares, overall = urls.fit(labelled, sample=200, rounds=1, depth=1)
    assert shares.count() == 12_000
    found = {r["_suffix"]: r["_share"] for r in shares.collect()}
    assert math.isclose(found["s9990.org"], (2 + urls.SMOOTHING * overall) / (2 + urls.SMOOTHING))
    pages = labelled.union(spark.range(9000).selectExpr("concat('http://s7.org/x', id % 5)", "0"))
    pages = urls.lexical(pages.union(spark.createDataFrame([("http://new.org", 0)], pages.schema)), "url")
    for limit in (urls.BROADCAST_BYTES, 0):  # broadcast, and joined
        joined = urls._with_share(pages, shares, overall, limit).select("_suffix", "_share").collect()
        assert len(joined) == 33_001
        assert all(r["_share"] == found.get(r["_suffix"], overall) for r in joined)
