import re

from pyspark.sql import functions as F

from tablemargin.llm import urlfilter
from tablemargin.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def brute(url, weights):
    if url is None or "://" not in url:
        host = path = ""
    else:
        host, path = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), v, h + p) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    score = urlfilter.score(weights, host, path)
    if fits:
        _, verdict, rule = max(fits)
        return host, path, rule, verdict, score
    return host, path, None, "block" if score >= 0.5 else "allow", score


def test_query_against_brute_force(spark):
    weights = urlfilter.fit()
    pages = {p.page_id: p.url for p in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = QUERIES["op8_url_filter"](spark, SF_DIR).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict, r.block_score) == brute(pages[r.page_id], weights)


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com/en", "https://example.com/en/",
            "https://a.b.example.com/en/1", "https://notexample.com/en/", "https://x.net/es/", "https://net/fr/", "https://x.net?/es/",
            "https://x.com#a", "ftp://u@x.com:80/a://b/c", "http://É.NET/fr/ü", "http://x.org/a\nb", "http://x.net/" + "a" * 50000]
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)] + [(4, urls[4], "z")], "page_id long, url string, rule string")
    weights = urlfilter.fit()
    got = urlfilter.filter_urls(df).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict, r.block_score) == brute(urls[r.page_id], weights)


def test_the_classifier_generalises():
    weights = urlfilter.fit()
    bad = [("blog.casino-win.example.net", "/en/1"), ("m.ads-track.example.com", "/en/2"), ("www.spam-farm.example.org", "/de/3"),
           ("blog.cheap-pills.example.net", "/en/4"), ("adult-x.example.com", "/en/5"), ("free-bets.example.net", "/de/45984")]
    good = [("blog.therthe.example.org", "/en/1"), ("www.thertion.example.org", "/de/44"), ("m.ththin.example.org", "/es/1.html")]
    assert all(urlfilter.score(weights, *u) >= 0.5 for u in bad) and all(urlfilter.score(weights, *u) < 0.5 for u in good)


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([("http://casino-win.example/slots",)], "url string")
    assert urlfilter.filter_urls(df, rules=()).first().verdict == "block"
    assert urlfilter.filter_urls(df.limit(0)).count() == 0
