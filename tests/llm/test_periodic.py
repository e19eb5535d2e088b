import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tablemargin.llm import periodic
from tablemargin.llm.queries import QUERIES


def brute_runs(w, least=12):
    """Every maximal stretch of every period, kept with its smallest period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i - q, j), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def split(text):
    return (text or "").encode().split()


def brute(doc, text):
    w = split(text)
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(w)
    if doc is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc, len(runs), *(best and (best[0], best[1], best[2], 1000 * best[1] // best[2]) or (None,) * 4),
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest())


def fibonacci(n):
    a, b = "x", "x y"
    while b.count(" ") < n:
        a, b = b, f"{b} {a}"
    return b


def odd_texts(rng):
    yield from (None, "", " \t\n", "one", "a " * 11, "a " * 12, "a " * 13, "a b " * 6, "É é " * 9, "a b c " * 40 + "a b", fibonacci(90))
    yield from ("x " + "a b a c " * 9 + "a b a d " * 5, ("a " * 20 + "b ") * 8, "a b " * 15, "A a " * 8)
    for _ in range(150):
        k, n = rng.choice([1, 2, 2, 3, 5, 40]), rng.randrange(1, 120)
        part = [rng.choice("abcdefghijklmnopqrstuvwxyz"[:min(k, 26)]) for _ in range(n)]
        if rng.random() < 0.6:
            p = rng.randrange(1, 30)
            part = part[:rng.randrange(len(part))] + part[:p] * rng.randrange(1, 8) + part[:rng.randrange(len(part))]
        yield rng.choice([" ", "\n", "  "]).join(part)


def test_digests_against_brute_force(spark, documents):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(odd_texts(rng))] + [(None, "a " * 30), (7, "b " * 15), (7, "b " * 15), (-10, "c d " * 20)]
    got = periodic.digests(documents(rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute(d, t) for d, t in rows), key=str)


def test_other_least_lengths(spark):
    rng = random.Random(9)
    for least in (1, 2, 3, 7, 16, 25):
        for _ in range(60):
            w = [rng.choice("ab") for _ in range(rng.randrange(0, 60))] * rng.choice([1, 2, 3])
            words = periodic.Words(periodic.pa.array([" ".join(w), "z", None, " ".join(w[::-1])]), lower=False)
            found = periodic.runs_of(words, least)
            assert sorted(found.get(0, [])) == brute_runs(w, least), (least, w)
            assert sorted(found.get(3, [])) == brute_runs(w[::-1], least), (least, w)


def test_very_long_repetitive_texts(spark, documents):
    line = " ".join(f"w{i}" for i in range(37)) + "\n"
    rows = [(1, "a " * 1_000_000), (2, line * 20_000), (4, "p q r s t u " + "".join(f"{i} p q r s t u " for i in range(50_000)))]
    got = {r.doc_id: r for r in periodic.collapse_runs(documents(rows)).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 1_000_000, 1)] and got[1].collapsed == "a"
    assert [tuple(x) for x in got[2].runs] == [(0, 740_000, 37)] and got[2].collapsed == line.strip()
    assert got[4].runs == []


def test_clashing_names_and_empty_table(spark, documents):
    df = documents([(1, "a " * 12)]).withColumns({"runs": F.lit(1), "_found": F.lit(2), "collapsed": F.lit(3)})
    [row] = periodic.collapse_runs(df).collect()
    assert row.collapsed == "a" and row["_found"] == 2 and row.doc_id == 1
    assert periodic.collapse_runs(df.limit(0)).count() == 0
    assert periodic.digests(df.limit(0)).count() == 0


def test_query_covers_the_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_periodic_runs"](spark, sf_dir).collect()
    short = {d.doc_id: d.text for d in docs if len(split(d.text)) < 700}
    assert len(got) == len(docs) and len(short) > 150
    assert sorted(tuple(r) for r in got if r.doc_id in short) == sorted(brute(d, t) for d, t in short.items())
