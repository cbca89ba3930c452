"""License scan, mixing and URL rules: DataFrame operations against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellindex.llm import license_scan, mixing, url_filter
from tests.llm.conftest import DOCS, rows_of, words

LICENSES = [
    "Released under the MIT License.",
    "the mit\nlicense, MIT-License mit licenses and İmit license",
    "GNU General Public License; general public  license general public",
    "Licensed under the Apache License, Version 2.0.",
    "Licensed under the Apache Software License, Version 2.0",
    "Permission is hereby granted, free of charge, to any one person obtaining a copy of this software",
    "mit", "license mit", None, "", "...", "all rights reserved all rights reserved",
]


def plain_scan(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(k, t.label) for t in license_scan.PHRASES for k in range(len(w)) if w[k : k + len(t.text.split())] == t.text.split()]
    starts = [k for k, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_licenses(spark):
    docs = spark.createDataFrame(rows_of(*enumerate(LICENSES), (None, LICENSES[0]), (0, LICENSES[0])), DOCS)
    rows = license_scan.scan(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    for k, text in enumerate(LICENSES):
        r = by_id[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_scan(text), text
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)
    assert by_id[3].labels == "apache,apache-2.0" and by_id[4].labels == "apache-2.0"  # a word put in
    assert by_id[5].labels == "mit-text" and by_id[5].base_labels == ""
    assert by_id[None].base_labels == "mit"


def test_license_spans(spark):
    text = "x " * 7 + "licensed under the apache free license version 2 0 " + "y " * 5 + "mit license"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    spans = {(r.label, r.first, r.last) for r in license_scan.matches(docs).filter("accepted").collect()}
    assert spans == {("apache-2.0", 7, 15), ("mit", 21, 22)}
    with pytest.raises(ValueError):
        license_scan.matches(docs, (license_scan.Template("one", "word"),))


def test_odd_rows(odd_docs, no_docs):
    assert len(license_scan.scan(odd_docs).collect()) == odd_docs.count()
    assert license_scan.scan(no_docs).collect() == []
    assert mixing.mix(no_docs, {"web": 1.0}).collect() == []
    mixed = mixing.mix(odd_docs, {"web": 1.0, None: 1.0}, rest=1.0, scale=3.0)
    assert set(mixed.columns) == set(odd_docs.columns) | {"copies", "shuffle_key"}
    assert mixed.count() > 0 and mixed.filter("source IS NULL").count() % 2 == 0  # equal rows draw alike


def plain_copies(seed, key, rate):
    pieces = math.ceil(rate / 8)
    total = 0
    for piece in range(1, pieces + 1):
        digest = hashlib.md5(f"{seed}:{key}:{piece}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / 16**13
        p = s = math.exp(-rate / pieces)
        for k in range(1, 66):
            if s > u:
                break
            total += 1
            p *= rate / pieces / k
            s += p
    return total


def test_poisson_copies(spark):
    rows = [(k, words(k, 3), "big" if k % 3 else "rare") for k in range(600)]
    docs = spark.createDataFrame(rows_of(*rows), DOCS)
    weights = {"rare": 0.9}  # 200 rows: rate 2.7, times 10
    out = mixing.mix(docs, weights, rest=0.1, scale=10.0, names=("c", "n", "place")).collect()
    got = Counter(r.doc_id for r in out)
    rate = {"rare": 0.9 / 1.0 * 600 * 10 / 200, "big": 0.1 / 1.0 * 600 * 10 / 400}
    assert got == {k: n for k, _, s in rows if (n := plain_copies("mix", k, rate[s]))}
    assert all(r.n == got[r.doc_id] and 1 <= r.c <= r.n for r in out)
    assert [r.place for r in out] == sorted(r.place for r in out)
    share = sum(r.source == "rare" for r in out) / len(out)
    assert abs(share - 0.9) < 0.02
    mean = sum(got[k] for k, _, s in rows if s == "rare") / 200
    spread = sum((got[k] - mean) ** 2 for k, _, s in rows if s == "rare") / 200
    assert abs(mean - 27) < 1.5 and 15 < spread < 45  # a Poisson draw has equal mean and variance


def test_weights(spark):
    docs = spark.createDataFrame(rows_of((1, "a", "x"), (2, "b", "y")), DOCS)
    assert {r.source for r in mixing.mix(docs, {"x": 1.0, "z": 5.0}, scale=50.0).collect()} == {"x"}
    assert mixing.mix(docs, {"x": 0.0, "y": 0.0}).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(docs, {"x": -1.0})


def plain_judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0]), len(r[1]), r[2]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


@pytest.mark.parametrize("part", [256, 2])
def test_url_rules(spark, monkeypatch, part):
    monkeypatch.setattr(url_filter, "PART", part)
    draw = random.Random(2)
    hosts = ["org", "example.org", "a.example.org", "b.a.example.org", "com", "x.com", "notexample.org", "EXAMPLE.org"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/en/12/x", "/es/", "/é/x", "/en/1?q=/es/", "#/en/", "/\U0010ffffz"]
    rules = [(h.lower(), p, draw.choice(["allow", "block"])) for h in hosts[:6] for p in ("", "/", "/en/", "/en/1", "/é", "/\U0010ffff") if draw.random() < 0.6]
    urls = [f"https://{h}{p}" for h in hosts for p in paths] * 3 + [None, "", "no scheme", "://", "http://", "a://b://c/en/", "http://.org/", "http://..", "http://x..com/en/"]
    pages = spark.createDataFrame([(k % 50 or None, u, "h", "host", 1) for k, u in enumerate(urls)], "page_id int, url string, html string, host string, rule int")
    got = [tuple(r)[1:] for r in url_filter.judge(pages, url_filter.rule_table(spark, rules + rules[:2])).collect()]
    assert Counter(got) == Counter(plain_judge(u, rules) for u in urls)


def test_url_rules_block_wins_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id int, url string")
    rules = url_filter.rule_table(spark, [("org", "/", "allow"), ("ORG", "/", "block"), (None, "/", "allow")])
    assert url_filter.judge(pages, rules).first().verdict == "block"
    assert url_filter.judge(pages, rules.limit(0), default="block").first().verdict == "block"
    assert url_filter.judge(pages.limit(0), rules).collect() == []


def test_columns_with_inner_names_stay(spark):
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"), F.lit("web").alias("source"), F.col("id").alias("__source"), (-F.col("id")).alias("__key"),
        F.lit(5).alias("__copies"), F.lit("x").alias("__CDF"), F.lit(2).alias("___name"), F.lit("t").alias("text"),
    )
    mixed = mixing.mix(docs, {"web": 1.0}, scale=3.0, names=("c", "cs", "k")).collect()
    assert mixed and all((r["__source"], r["__key"], r["__copies"], r["__CDF"], r["___name"]) == (r.doc_id, -r.doc_id, 5, "x", 2) for r in mixed)


def test_hot_hosts_are_swept_in_parts(spark):
    """The windows get an exchange of their own, by host and part, also where no side of a join is broadcast."""
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.com/fr/"), F.col("id").cast("string")).alias("url"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        judged = url_filter.judge(pages, url_filter.rule_table(spark, url_filter.RULES))
        plan = judged._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(rule_host#\d+, part#\d+", plan)
        assert judged.filter("verdict = 'allow' AND rule = 'com/fr/'").count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
