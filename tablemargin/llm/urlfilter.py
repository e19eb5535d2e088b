"""URL filter: host and path rules first, then a logistic regression on hashed character n-grams of host and path.

The classifier is trained from a small labelled URL table (`LABELLED` by default) on the driver; its weights are a
vector of fixed length. Rules are plain column expressions.

Defined results: a NULL url, or one without "://", has an empty host and path, meets no rule and is judged by the
classifier's intercept. A host is compared as it stands, a port or user part included. Of several rules that fit, the
longest wins; two rules of equal text are the same rule. Rows are judged one by one, so repeated rows agree; output
columns replace input columns of the same name.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: (verdict, host, path): the rules of the registered query. Fixed values.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# Training table of URLs that a crawl should leave out (gambling, pills, adult, link farms, trackers) and of ordinary
# ones. Fixed values.
BLOCKED_URLS = """
https://casino-royal.example/slots/play  http://www.casino-win.example/en/jackpot  https://best-casino.example/bonus
https://online-slots.example/spin  http://poker-cash.example/tables  https://free-bets.example/sport/odds
https://m.bets-now.example/live  http://betting-tips.example/en/1  https://lottery-win.example/ticket
https://cheap-pills.example/buy/viagra  http://pills-online.example/order  https://www.pharma-cheap.example/cialis
https://discount-meds.example/pills  http://viagra-shop.example/  https://weight-loss-pills.example/buy-now
https://adult-x.example/video/1  http://xxx-tube.example/watch  https://porn-hub.example/hot  https://sex-cams.example/live
http://adult-dating.example/girls  https://hot-xxx.example/free  http://nude-cams.example/
https://spam-farm.example/link/1  http://link-farm.example/out?id=3  https://www.seo-spam.example/backlinks/buy
http://buy-followers.example/cheap  https://backlinks.example/farm  http://spam-blog.example/page/77
https://ads-track.example/click?id=9  http://track.ads-server.example/pixel.gif  https://adserver.example/banner/728
http://click-track.example/redirect  https://popup-ads.example/go  http://m.ads-click.example/track/5
https://free-iphone-win.example/claim  http://win-prize.example/survey  https://crack-serials.example/keygen
http://warez-download.example/crack  https://payday-loans.example/apply-now  http://fast-cash-loans.example/easy
https://replica-watches.example/cheap  http://cheap-handbags.example/outlet
""".split()
ORDINARY_URLS = """
https://www.nation-news.example/en/politics/article-12  https://blog.garden.example/de/rosen  http://history.example/wiki/rome
https://tionsh.example/en/4301  https://m.thonth.example/es/22091  https://ththan.example/fr/40404
https://blog.theran.example/de/100  http://www.therse.example/en/7  https://reference.example/docs/install.html
https://library.example/catalog/item/3390  https://university.example/courses/algebra  http://museum.example/collection/1882
https://city-council.example/services/waste  https://weather.example/forecast/tomorrow  http://recipes.example/soup/lentil
https://www.science-journal.example/vol/3/paper.pdf  https://travel.example/guide/lisbon  http://music-school.example/lessons
https://forum.example/thread/88?page=2  https://code.example/project/readme  http://www.health.example/advice/sleep
https://newspaper.example/2024/05/economy.html  https://m.sports.example/team/results  http://archive.example/letters/1910
https://blog.therthe.example/en/9020/  https://www.thationer.example/fr/301#top  http://ertion.example/es/11.html
https://planet.example/stars/orion  https://kitchen.example/bread  http://school.example/timetable
https://m.thered.example/en/55?utm_source=feed  https://blog.ththing.example/en/27  http://onther.example/de/9
https://bank.example/branches  https://railway.example/stations/map  http://theatre.example/programme/may
https://www.ththerin.example/en/4  https://therati.example/fr/6?page=2&ref=x  https://blog.thontha.example/es/3310
https://nature.example/birds/heron  http://law.example/code/article/9  https://election.example/results/2019
""".split()
LABELLED = [(url, 1) for url in BLOCKED_URLS] + [(url, 0) for url in ORDINARY_URLS]

GRAMS = (3, 4, 5)
BUCKETS = 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end; empty without "://"."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def grams(host: str, path: str) -> list[int]:
    """Buckets of the character n-grams of host and path, which are told apart."""
    out = []
    for field, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        data = text.encode("utf-8", "surrogatepass")
        seed = zlib.crc32(field.encode())
        out += [zlib.crc32(data[i:i + n], seed) % BUCKETS for n in GRAMS for i in range(len(data) - n + 1)]
    return out


def _parts(url: str) -> tuple[str, str]:
    rest = url.split("://", 1)[1]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    return rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]


def fit(labelled: Sequence[tuple[str, int]] = LABELLED, rounds: int = 400, rate: float = 2.0, decay: float = 1e-3) -> np.ndarray:
    """Weights of the n-gram buckets, the intercept last, by gradient descent over the small labelled table."""
    rows = [np.unique(grams(*_parts(url))) for url, _ in labelled]
    y = np.array([label for _, label in labelled], dtype=float)
    x = np.zeros((len(rows), BUCKETS + 1))
    for i, row in enumerate(rows):
        x[i, row] = 1 / np.sqrt(max(1, len(row)))
    x[:, -1] = 1
    used = np.flatnonzero(x.any(axis=0))
    dense, w = x[:, used], np.zeros(len(used))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-dense @ w))
        w -= rate * (dense.T @ (p - y) / max(1, len(y)) + decay * np.r_[w[:-1], 0])
    weights = np.zeros(BUCKETS + 1)
    weights[used] = w
    return weights


def score(weights: np.ndarray, host: str, path: str) -> float:
    """Probability that the URL is one to block."""
    row = list(set(grams(host, path)))
    z = weights[-1] + weights[row].sum() / np.sqrt(max(1, len(row)))
    return float(1 / (1 + np.exp(-z)))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, or NULL."""
    longest_first = sorted(set(rules), key=lambda r: (-len(r[1] + r[2]), r))
    whens = [(((host == h) | host.endswith("." + h)) & path.startswith(p),
              F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))) for verdict, h, p in longest_first]
    if not whens:
        return F.lit(None).cast("struct<verdict:string,rule:string>")
    return reduce(lambda chain, when: chain.when(*when), whens[1:], F.when(*whens[0]))


def filter_urls(df: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
                labelled: Sequence[tuple[str, int]] = LABELLED, threshold: float = 0.5) -> DataFrame:
    """`df` with host, path, the rule that decided (or NULL), the classifier's block_score and the verdict."""
    weights = fit(labelled)

    @F.arrow_udf("double")
    def block_score(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([score(weights, h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist())], pa.float64())

    found = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    found = found.withColumns({"block_score": block_score("host", "path"),
                               "rule": rule_for(F.col("host"), F.col("path"), rules)})
    method = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    return found.withColumns({"verdict": F.coalesce(F.col("rule.verdict"), method), "rule": F.col("rule.rule")})
