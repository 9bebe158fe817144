import random
import re

import pytest
from pyspark.sql import functions as F

from overlake.llm import queries, urls
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
URLS = [
    None,
    "",
    "no scheme.org/es/",
    "http://org/",
    "http://example.org",
    "http://example.org?x=/es/",
    "http://example.org/es/a",
    "http://a.EXAMPLE.org/es/",
    "http://a.example.org/ES/",
    "http://notexample.org/es/1",
    "http://example.org/en/1",
    "http://example.org/en/123#es",
    "http://example.org/en/2",
    "https://x.com/fr/de/",
    "https://x.com/de/fr/?u=http://example.org/es/",
    "https://x.com/it/?u=http://example.org/es/",
    "https://com/de/",
    "https://com/de",
    "//x.org/",
    "://org/",
    "ftp://user@x.org:80/es/",
    "https://casino.example.net/a",
    "https://casinos.example.net/a",
    "https://www.cheap-PILLS.example.com/x",
    "https://ads.doubleclick.net/x",
    "https://doubleclick.net.evil.example/x",
    "https://en.wikipedia.org/wiki/Casino",
    "https://example.net/wikipedia.org/casino",
    "https://example.net/?q=poker",
    "https://example.net/AdServer/1",
    "https://exämple.net/ﬀ/Kasino/casino",
    "https://x.net/line\nbreak/casino",
    "https://x.net/" + "a/" * 5000 + "xxx",
]


def judged(pages, **how):
    return {r["page_id"]: r for r in urls.judge(pages, **how).select("page_id", "filtered.*").collect()}


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")


def plain(url, rules=urls.RULES, default="allow"):
    """Every rule against the URL."""
    host, path, address = brute.url_parts(url)
    low = address.translate(brute.LOWER)
    fitting = [r for r in rules if address and re.search(r.regex, address if r.by_host else low)]
    best = max(fitting, key=lambda r: r.strength, default=None)
    return (
        host,
        path,
        best.text if best and best.by_host else None,
        best.text if best and not best.by_host else None,
        best.action if best else default,
    )


def test_rules_and_parts(spark):
    found = judged(table(spark, URLS))
    assert len(found) == len(URLS)
    for i, url in enumerate(URLS):
        rule, verdict = brute.url_rule(url)
        r = found[i]
        assert (r["host"], r["path"], r["rule"]) == (*brute.url_parts(url)[:2], rule)
        assert verdict is None or r["verdict"] == verdict
        assert tuple(r) [1:] == plain(url)
    blocked = {URLS[i] for i, r in found.items() if r["pattern"] and r["verdict"] == "block"}
    assert len(blocked) == 9 and "https://casinos.example.net/a" not in blocked


def test_patterns():
    cases = {
        "||ads.example.com/": (["ads.example.com/", "x.ads.example.com/y"], ["bads.example.com/", "y.net/ads.example.com/"]),
        "^ad^": (["ad.x/", "x.y/ad", "x.y/a-ad-b"], ["bad.x/", "x.y/adx"]),
        "|a.b/": (["a.b/c"], ["x.a.b/"]),
        "/end|": (["x.y/end"], ["x.y/end/"]),
        "x*y^": (["x.com/12y", "xy/"], ["x.com/yes"]),
        "a+b(c)": (["h/a+b(c)"], ["h/aab(c)", "h/aabc"]),
    }
    for text, (hits, misses) in cases.items():
        rule = urls.pattern(text)
        assert all(re.search(rule.regex, h) for h in hits) and not any(re.search(rule.regex, m) for m in misses)
        # Whatever fits holds every token whole.
        assert all(set(rule.tokens) <= set(re.split("[^0-9a-z]+", h)) for h in hits)
    assert urls.pattern("x*y^").tokens == () and urls.pattern("||ads.example.com/").tokens == ("ads", "example", "com")
    assert urls.host_rule("block", "Example.org/en/1").tokens == ("example", "org", "en")
    for bad in ("example.org", "/x", "a.org/?q"):
        with pytest.raises(ValueError):
            urls.host_rule("block", bad)
    with pytest.raises(ValueError):
        urls.pattern("*^*")


def test_random_urls_like_every_rule(spark):
    draw = random.Random(1)
    parts = ["ads", "ad", "x", "example", "org", "com", "de", "1", "banner", "A"]
    rules = [urls.pattern(p) for p in ("^ads^", "ad*x", "||ads.", "/1|", "@@^banner^", "de.com/", "|x.", "*1*a")]
    rules += [urls.host_rule("block", "com/de/"), urls.host_rule("allow", "ads.com/d"), urls.host_rule("allow", "com/")]
    texts = ["http://" + "".join(draw.choice(parts) + draw.choice("./-?#.") for _ in range(draw.randint(1, 7))) for _ in range(500)]
    found = judged(table(spark, texts), rules=rules, default="unknown")
    for i, url in enumerate(texts):
        assert tuple(found[i])[1:] == plain(url, rules, "unknown")
    assert len({r["verdict"] for r in found.values()}) == 3


def test_index_takes_the_rarest_token(spark):
    texts = ["http://a.common.org/x"] * 5 + [f"http://common.org/{i}" for i in range(20)] + ["http://rare.common.org/"]
    listed = urls._table(spark, [urls.pattern("||rare.common.org/"), urls.pattern("common"), urls.pattern("^absent^common^")])
    held = urls.addresses(table(spark, texts))
    # Copies are one URL.
    assert held.count() == 22
    chosen = {r["rule_text"]: r["token"] for r in urls.index(held, listed).collect()}
    assert chosen == {"||rare.common.org/": "rare", "common": "", "^absent^common^": "absent"}
    fetched = urls.candidates(held, urls.index(held, listed)).groupBy("rank").count().collect()
    # Only the rule without a token meets every URL.
    assert sorted(r["count"] for r in fetched) == [1, 22]


def test_native_and_odd_rows(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.org/", 5, "x"), (1, "http://a.org/", 5, "x"), (None, None, None, None), (2, "http://b.com/de/", 0, "y")],
        "page_id long, url string, rank int, filtered string",
    ).withColumn("token", F.lit(1))
    found = urls.judge(pages)
    assert found.columns == ["page_id", "url", "rank", "token", "filtered"]
    assert sorted((r["filtered"]["verdict"] for r in found.collect())) == ["allow", "allow", "allow", "block"]
    assert urls.judge(pages.limit(0)).count() == 0
    assert {r["filtered"]["verdict"] for r in urls.judge(pages, rules=()).collect()} == {"allow"}
    plan = queries.op13_urls(spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
    # Of the pages only two columns are read.
    assert "html" not in plan.split("== Physical Plan ==")[1]
