from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from caseloom.llm import sharding, url_filter
from caseloom.llm.queries import URL_RULES

MASK = (1 << 64) - 1


def jump(key: int, n: int) -> int:
    state, at, following = key & MASK, 0, 0
    while following < n:
        at = following
        state = (state * sharding.MULTIPLIER + sharding.INCREMENT) & MASK
        following = int((at + 1) * ((1 << 31) / ((state >> 33) + 1)))
    return at


def test_jump_equals_the_plain_walk(spark):
    keys = [0, 1, -1, 7, 123456789, -(1 << 63), (1 << 63) - 1, *range(1000, 1200)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    counts = (1, 2, 5, 16, 17, 100)
    row = df.select("k", *(sharding.jump_shard(F.col("k"), n).alias(f"n{n}") for n in counts)).collect()
    assert all(r[f"n{n}"] == jump(r["k"], n) for r in row for n in counts)


def test_slots_and_growth(spark):
    rows = [(k, k) for k in range(3000)] + [(None, 1), (None, 2), (5, 9)]
    df = spark.createDataFrame(rows, "k long, shard int").repartition(5)
    found = sharding.shard_by_key(df, "k", 16, blocks=8).collect()
    assert len(found) == len(rows)
    for shard in range(16):
        own = sorted(r.slot for r in found if r.shard == shard)
        assert own == list(range(len(own))) and 120 < len(own) < 260
    assert all(r.grown_shard in (r.shard, 16) for r in found)
    assert 100 < sum(r.grown_shard == 16 for r in found) < 260
    assert len({r.shard for r in found if r.k is None}) == 1
    text = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    assert len(sharding.shard_by_key(text, "k", 3).collect()) == 3
    assert sharding.shard_by_key(df.where("false"), "k", 16).collect() == []


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x?y#z", "http://a.example.net", "x://net/",
    "http://net", "http://example.com/de/", "http://example.com/de", "http://badexample.com/de/",
    "http://m.example.com/de/1://x", "http://b.org/fr/?q", "http://org?/fr/", "http://É.NET/Ä", "http://x.net#/a",
    "ftp://h/p" + "a" * 5000,
]


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def brute_rule(host, path):
    found = None
    for rule in ("net/", "example.net/en/", "example.com/de/", "org/fr/"):
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            found = max(found or "", rule, key=len)
    return found


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)], "page_id long, url string, host string")
    model = url_filter.UrlClassifier(constant=0.0)
    found = url_filter.judge(pages, "url", URL_RULES, model).orderBy("page_id").collect()
    for row, url in zip(found, URLS, strict=True):
        host, path = brute_parts(url)
        rule = brute_rule(host, path)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == ("block" if rule in ("net/", "example.com/de/") else "allow")


def test_classifier_on_unseen_urls(spark):
    """Hosts and paths never seen in training, of the same two kinds."""
    good = [f"http://site{k}.example.org/docs/page{k}.html" for k in range(150)]
    bad = [f"http://win{k}.casino-prize.biz/click/{k}" for k in range(150)]
    rows = [(u, 0) for u in good] + [(u, 1) for u in bad]
    df = spark.createDataFrame(rows, "url string, label int")
    host, path = url_filter.url_parts(F.col("url"))
    df = df.select("url", "label", host.alias("host"), path.alias("path"))
    seen = df.where(F.crc32(F.col("url").cast("binary")) % 3 != 0)
    held_out = df.where(F.crc32(F.col("url").cast("binary")) % 3 == 0)
    model = url_filter.UrlClassifier.train(seen, max_rows=150)
    found = model.score(held_out, "p").collect()
    assert len(found) > 50 and all((r.p >= 0.5) == bool(r.label) for r in found)


@pytest.mark.parametrize("rows", [[], [("a.b", "/", 1)], [("a.b", "/", 1), (None, None, 1)]])
def test_nothing_to_learn(spark, rows):
    model = url_filter.UrlClassifier.train(spark.createDataFrame(rows, "host string, path string, label int"))
    assert model.model is None and model.constant == (1.0 if rows else 0.0)
    assert model.score(spark.createDataFrame([("h", "/")], "host string, path string")).first()["block_score"] == model.constant


def test_a_repeated_url_takes_one_place_of_the_sample(spark):
    urls = [(f"h{k}.com", f"/{'bad' if k % 2 else 'good'}/{k}", k % 2) for k in range(40)]
    first = spark.createDataFrame(urls, "host string, path string, label int").orderBy(F.xxhash64("host", "path")).first()
    rows = spark.createDataFrame(urls + [tuple(first)] * 60, "host string, path string, label int")
    classifier = url_filter.UrlClassifier.train(rows, max_rows=40)
    assert classifier.model is not None
    asked = spark.createDataFrame([("x.com", "/bad/1"), ("x.com", "/good/1")], "host string, path string")
    found = {r.path: r.block_score for r in classifier.score(asked).collect()}
    assert found["/good/1"] < 0.5 < found["/bad/1"]
