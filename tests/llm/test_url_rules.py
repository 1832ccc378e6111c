"""Url rules: explicit rules by hand, mined ones against a plain enumeration of token sets."""

from __future__ import annotations

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievewright.llm import url_rules
from sievewright.llm.queries import URL_RULES

CASES = [
    (None, "", "", None),
    ("", "", "", None),
    ("example.com/en/", "", "", None),
    ("http://Example.COM/en/1", "example.com", "/en/1", ("example.com/en/", "block")),
    ("https://a.b.example.com/en/?q=/x", "a.b.example.com", "/en/", ("example.com/en/", "block")),
    ("https://www.example.com/en/1#x", "www.example.com", "/en/1", ("www.example.com/en/", "allow")),
    ("https://m.www.example.com/en/1", "m.www.example.com", "/en/1", ("www.example.com/en/", "allow")),
    ("https://badexample.com/en/1", "badexample.com", "/en/1", ("com/", "allow")),
    ("https://x.com", "x.com", "", None),
    ("https://x.com?a=b", "x.com", "", None),
    ("http://x.net/es/a", "x.net", "/es/a", ("net/es/", "block")),
    ("http://net/fr/", "net", "/fr/", ("net/fr/", "block")),
    ("http://x.net/esp/a", "x.net", "/esp/a", None),
    ("http://É.Com/A\nb://c", "É.com", "/A\nb://c", ("com/", "allow")),
    ("://x.com/y", "x.com", "/y", ("com/", "allow")),
    ("http:///en/", "", "/en/", None),
]


def test_explicit_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, (u, *_) in enumerate(CASES)], "page_id long, url string")
    pages = pages.withColumns({"host": F.lit("clash"), "tokens": F.lit(1), "verdict": F.lit("x")})
    found = {r.page_id: r.judged for r in url_rules.judge(pages, URL_RULES).select("page_id", "judged").collect()}
    for i, (_, host, path, told) in enumerate(CASES):
        assert (found[i].host, found[i].path) == (host, path)
        assert found[i].rule == (told[0] if told else None)
        if told:
            assert found[i].verdict == told[1]
    assert url_rules.judge(pages.limit(0), URL_RULES).count() == 0
    assert url_rules.judge(pages, URL_RULES).count() == len(CASES)


def mined_by_hand(baskets, mining):
    """All rules by counting every token set."""
    sets, total = Counter(), len(baskets)
    for tokens, verdict in baskets:
        for n in range(1, len(tokens) + 1):
            for items in itertools.combinations(sorted(tokens), n):
                sets[items, None] += 1
                sets[items, verdict] += 1
    least = -(-mining.support * total // 1)
    rules = {
        (items, verdict): (n / sets[items, None], n / total)
        for (items, verdict), n in sets.items()
        if verdict and n >= least and n / sets[items, None] >= mining.confidence
    }
    return {
        k: v for k, v in rules.items()
        if not any(o[1] == k[1] and set(o[0]) < set(k[0]) and rules[o][0] >= v[0] for o in rules)
    }


def test_mined_rules_and_verdicts_equal_enumeration(spark):
    folder = "/root/testdata/sf0.01"
    mining = url_rules.MiningRules(0.02, 0.8)
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    pages = pages.union(pages.limit(5)).union(spark.createDataFrame([(None, None), (9000, "no url")], pages.schema))
    url = F.col("url")
    host, path = url_rules.host_of(url), url_rules.path_of(url)
    told = pages.select("url", url_rules.tokens_of(url, host, path).alias("tokens"), url_rules.explicit(host, path, URL_RULES)["verdict"].alias("verdict"))
    rows = {r.url: r for r in told.filter("url like '%://%'").collect()}
    rules = mined_by_hand([(r.tokens, r.verdict) for r in rows.values() if r.verdict], mining)
    found = url_rules.mine(told.filter("url like '%://%'").distinct().select("tokens", "verdict"), mining).collect()
    assert {(tuple(r["items"]), r.verdict): (r.confidence, r.support) for r in found} == {k: pytest.approx(v) for k, v in rules.items()}
    judged = url_rules.judge(pages, URL_RULES, mining).collect()
    assert len(judged) == pages.count()
    for r in judged:
        own = rows.get(r.url)
        if own is None or own.verdict is None:
            held = [(*v, " ".join(k[0]), k[1]) for k, v in rules.items() if own is not None and set(k[0]) <= set(own.tokens)]
            assert r.judged.verdict == (max(held)[3] if held else "allow")
        else:
            assert r.judged.verdict == own.verdict


def test_no_labelled_urls(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a"), (1, "http://x.org/a"), (2, None)], "page_id long, url string")
    assert [r.judged.verdict for r in url_rules.judge(pages, URL_RULES).collect()] == ["allow"] * 3


def test_main_path_has_no_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = url_rules.judge(pages, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
