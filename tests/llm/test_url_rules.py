from __future__ import annotations

import random

from pyspark.sql import functions as F

from caremeld.llm import url_rules as U

URLS = [
    None, "", "no scheme", "http://example.net/en/1", "http://EXAMPLE.net/EN/", "https://a.b.example.net", "https://a.net/",
    "ftp://x.org/fr/", "ftp://x.org/fr", "http://org/fr/a?b#c", "http://xorg/fr/", "http://m.example.com/de/9", "http://example.com?x=/de/",
    "http://spam-farm.example.org/es/", "http://nospam-farm.org/", "http://a/spam-farm/", "http://www.casino-win.example.com:80/",
    "x://y://z.net/", "http://é.net/é", "http://example.net/en", "http://net/", "http://a.net\n/", "://net/", "http://u@ads-track.com#net/",
]


def plain(url):
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", None, "allow"
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, path = rest[:cut].encode().lower().decode(), rest[cut:]
    path = path[: min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    best = None
    for rule, verdict in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")):
        rule_host, _, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            best = max(best or ("", ""), (rule, verdict), key=lambda r: len(r[0]))
    words = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    padded = "." + host.replace("-", ".") + "."
    bad = any("." + w.replace("-", ".") + "." in padded and w in host for w in words)
    return host, path, best and best[0], best[1] if best else "block" if bad else "allow"


def test_against_plain(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS[:2])], "page_id long, url string")
    host, path = U.parts(F.col("url"))
    rows = pages.select("url", host.alias("host"), path.alias("path"), U.judged(pages).alias("j")).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        assert (r.host, r.path, r.j.rule, r.j.verdict) == plain(r.url), r.url
    assert pages.limit(0).select(U.judged(pages).alias("j")).count() == 0


def test_index_fetches_every_rule_that_fits():
    rng = random.Random(1)
    words = "alpha beta net x1 shop gamma delta org com four five six".split()
    rules = [U.word_rule("-".join(rng.sample(words, 2))) for _ in range(20)]
    rules += [U.host_rule(f"{rng.choice(words)}.{rng.choice(words)}/{rng.choice(words)}{rng.choice(['', '/'])}", U.ALLOW) for _ in range(20)]
    rules.append(U.Rule("digits", U.BLOCK, r"\d{3}", ()))
    index, fetched = U.RuleIndex(tuple(rules)), []
    for _ in range(300):
        url = f"http://{rng.choice(words)}{rng.choice('.-')}{rng.choice(words)}{rng.choice(['', '.' + rng.choice(words)])}/{rng.choice(words)}/{rng.randint(1, 999)}"
        fits = {i for i, (_, expression) in enumerate(index.rules) if expression.search(url)}
        assert fits <= set(index.candidates(url))
        fetched.append(len(index.candidates(url)))
    assert sum(fetched) / len(fetched) < len(rules) / 2


def test_general_patterns_on_other_urls():
    """Urls that are not in the given tables, by category, and clean ones."""
    index = U.RuleIndex(U.HOST_RULES + U.PATTERN_RULES)
    bad = [
        "http://adserver.example.com/x", "https://ads.site.com/", "http://site.com/banner-ads/1", "http://casino-royal.example.com/",
        "https://online.poker.site.com", "http://site.com/a/free-spins/b", "http://adult-y.example.com/", "http://www.site.xxx/",
        "http://cheap-viagra.site.com/", "http://site.com/payday-loans/?x", "http://site.com/ADS/x",
    ]
    clean = [
        "http://loads.example.com/", "http://essex.example.com/sextet/", "http://site.com/adsorption/", "http://site.com/news?p=/ads/", "http://site.com/a#/porn/",
        "http://pokers-guide.example.com/", "http://site.com/wiki/casino", "http://threads.com/en/1", "http://anti-spam.com/", "http://site.com/ads",
    ]
    assert [u for u in bad if index.judge(u)[1] != U.BLOCK] == []
    assert [u for u in clean if index.judge(u)[1] != U.ALLOW] == []
    assert max(len(index.candidates(u)) for u in bad + clean) <= 12 < len(index.rules) / 5
