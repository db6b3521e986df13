import math

import pytest
from pyspark.sql import functions as F

from detour.llm import common, urlmodel
from detour.llm.queries import URL_RULES

from .helpers import SMALL, table

PAGES = "page_id long, url string, host string, verdict string"
URLS = [None, "", "no scheme.com/x", "http://a.com", "http://a.com/", "HTTP://A.COM/En/", "https://example.com/en/1", "https://www.example.com/en/1",
        "https://WWW.example.com/EN/1", "https://x.net/es/1?q#f", "https://net/fr/", "https://x.net/fr", "ftp://notcom/x", "https://b.org/a?b://c/d",
        "https://b.org#frag/x", "http://üñí.com/é", "https://x.net/es/" + "a" * 5000, "https://b.org/😀", "a://b://c.com/", "https://b.org/a?b://c/d"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    best = None
    for verdict, r in URL_RULES:
        domain, _, start = r.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start) and (best is None or len(r) > len(best[1])):
            best = (verdict, r)
    return best or (None, None)


def check(got, pages):
    assert sorted(repr(r.page_id) for r in got) == sorted(repr(p.page_id) for p in pages)
    urls = {}
    for p in pages:
        urls.setdefault(p.page_id, []).append(p.url)
    for r in got:
        seen = [(*parts(u), *rule(*parts(u))) for u in urls[r.page_id]]
        assert any((r.host, r.path, r.rule) == (h, p, name) and (verdict is None or r.verdict == verdict) for h, p, verdict, name in seen)
        assert r.verdict in ("allow", "block") and (r.score is None) == (r.rule is not None)


def test_parts_rules_and_odd_urls(spark):
    pages = table(spark, [(i, u, "h", "v") for i, u in enumerate(URLS)] + [(None, "https://a.com/", "h", "v")], PAGES)
    got = urlmodel.judge(pages, URL_RULES).collect()
    check(got, pages.collect())
    assert len({r.score for r in got if r.page_id in (13, 19)}) == 1


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    check(urlmodel.judge(pages, URL_RULES).collect(), pages.collect())


def test_empty(spark):
    assert urlmodel.judge(table(spark, [], PAGES), URL_RULES).count() == 0


def model(urls):
    """Witten-Bell probability of a character, from order ORDER down."""
    counts = {}
    for u in urls:
        p = urlmodel.START * urlmodel.ORDER + u + urlmodel.END
        for i in range(urlmodel.ORDER, len(p)):
            for n in range(urlmodel.ORDER + 1):
                counts.setdefault(p[i - n:i], {}).setdefault(p[i], 0)
                counts[p[i - n:i]][p[i]] += 1

    def prob(gram):
        p = 1 / urlmodel.ALPHABET
        for n in range(urlmodel.ORDER + 1):
            ctx = gram[urlmodel.ORDER - n:urlmodel.ORDER]
            if (seen := counts.get(ctx)):
                p = (seen.get(gram[-1], 0) + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p
    return prob


def test_ratios_against_brute_force(spark):
    good, bad, new = ["good.org/abc", "good.org/abd", "x"], ["bad.org/zzz", "bad.net/zz"], ["good.org/zz", "", "totally new"]
    rows = [(i, u, lab, False) for i, (u, lab) in enumerate([*[(g, "allow") for g in good], *[(b, "block") for b in bad], *[(n, None) for n in new]])]
    every = urlmodel.grams(spark.createDataFrame(rows, "uid long, url string, label string, held boolean"))
    one = lambda v: F.sum((F.col("label") == v).cast("long")).alias(v)
    counts = every.where("label is not null").groupBy("gram").agg(one("allow"), one("block"))
    got = urlmodel.ratios(counts, every.where("label is null").select("gram").distinct(), common.scratch(spark, "test")).collect()
    a, b = model(good), model(bad)
    assert len(got) > 10
    for r in got:
        assert r.ratio == pytest.approx(1e6 * math.log(a(r.gram) / b(r.gram)), abs=2)


def test_model_separates_what_it_learned(spark):
    rows = [(i, f"http://h{i}.com/{'cheap-pills' if False else 'story'}/{i}", "h", "v") for i in range(60)]
    rows += [(100 + i, f"http://h{i}.net/es/cheap-pills-buy/{i}", "h", "v") for i in range(60)]
    rows += [(300 + i, f"http://h{i}.org/{'es/cheap-pills-buy' if i % 2 else 'story'}/{i}", "h", "v") for i in range(20)]
    got = {r.page_id: r.verdict for r in urlmodel.judge(table(spark, rows, PAGES), URL_RULES).collect()}
    assert [got[300 + i] for i in range(20)] == ["block" if i % 2 else "allow" for i in range(20)]


def test_threshold():
    assert urlmodel.threshold([]) == 0 and urlmodel.threshold([(3, 5, 0)]) == 0
    assert urlmodel.threshold([(-50, 0, 4), (50, 4, 0)]) == pytest.approx((-49 + 50) / 2 / 100)
    low = urlmodel.threshold([(-50, 1, 9), (10, 5, 1), (50, 4, 0)])
    assert -0.49 <= low <= 0.11
