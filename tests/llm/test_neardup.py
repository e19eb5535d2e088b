import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemargin.llm import components, neardup
from tablemargin.llm.queries import QUERIES
from tablemargin.sources.tables import stage

SF_DIR = "/root/testdata/sf0.001"


def shingles(text, k=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, k=4):
    sets = [shingles(t, k) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_shingle = {}
    for i, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    for a in range(len(docs)):
        for b in {b for x in sets[a] for b in by_shingle[x] if b > a}:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(b)] = find(a)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(docs))


def rows(df):
    return sorted(tuple(r[c] for c in ("doc_id", *neardup.RESULTS)) for r in df.collect())


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, sf_dir):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows(QUERIES["op3_near_duplicates"](spark, sf_dir)) == brute(docs)


def family(rng, n, length, edits, vocabulary):
    base = rng.choices(vocabulary, k=length)
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(length)] = rng.choice(vocabulary)
        yield " ".join(copy)


def test_a_large_loose_group_keeps_its_links(documents):
    """Copies that differ more from each other than from their common source, in blocks much smaller than the group."""
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(3000)]
    texts = [*family(rng, 250, 120, 9, vocabulary), *family(rng, 60, 300, 30, vocabulary), *family(rng, 40, 9, 2, vocabulary)]
    rng.shuffle(texts)
    block, neardup.BLOCK = neardup.BLOCK, 16
    try:
        got = rows(neardup.near_duplicates(documents(list(enumerate(texts)))))
    finally:
        neardup.BLOCK = block
    assert got == brute(list(enumerate(texts)))


def test_odd_rows(documents):
    docs = [(1, None), (2, ""), (3, "  "), (4, "One"), (5, "one"), (6, "one two three"), (7, "ONE two  three"), (8, "a b c d e"),
            (8, "a b c d e"), (9, "a b c d e"), (10, "É b c d"), (11, "é b c d"), (12, "x " * 40000)]
    df = documents(docs).withColumn("kept", F.lit(1))
    got = neardup.near_duplicates(df)
    assert rows(got) == brute(docs) and "source" in got.columns
    nobody = rows(neardup.near_duplicates(documents([(3, "p q r s"), (None, "p q r s")]).filter("doc_id is not null")))
    assert nobody == [(3, 1, 3, True)]
    unnamed = neardup.near_duplicates(documents([(None, "p q r s"), (3, "p q r s"), (None, "z")])).collect()
    assert sorted((str(r.component_id), r.kept) for r in unnamed) == [("3", False), ("3", True), ("None", False)]


def test_empty_table(documents):
    assert neardup.near_duplicates(documents([])).count() == 0


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for n_a, n_b, both in [(1000, 900, 850), (500, 500, 100), (300, 1200, 300), (50, 50, 45)]:
        a, b = pool[:n_a], pool[n_a - both:n_a - both + n_b]
        x, y = neardup.registers([np.sort(a), np.sort(b)])
        larger, smaller = (x > y).sum(), (x < y).sum()
        counts = [np.array([x]) for x in (larger, smaller, len(x) - larger - smaller, float(n_a), float(n_b))]
        low, j = 0.0, min(n_a / n_b, n_b / n_a)
        for _ in range(30):
            low, j = ((low + j) / 2, j) if neardup.likely((low + j) / 2, *counts)[0] else (low, (low + j) / 2)
        assert abs(j - both / (n_a + n_b - both)) < 0.13


def test_registers_merge():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 1 << 63, 300, dtype=np.uint64), rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    x, y, union = neardup.registers([a, b, np.concatenate([a, b])])
    assert (np.maximum(x, y) == union).all()


def test_components_of_a_long_chain(spark):
    links = spark.range(0, 60).selectExpr("id + 1 as a", "id as b").unionByName(spark.createDataFrame([(100, 101), (7, 7)], "a long, b long"))
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_roots_are_read_without_another_shuffle(spark):
    links = spark.createDataFrame([(1, 0), (2, 1), (5, 4)], "a long, b long")
    roots = components.roots_of_others(links)
    assert "Exchange" not in roots._jdf.queryExecution().executedPlan().toString()
    assert {r.node: r.root for r in roots.collect()} == {1: 0, 2: 0, 5: 4}


def test_a_group_of_related_texts_writes_no_pairs_of_its_members(documents, monkeypatch):
    """Texts that all pass the estimate with each other, and are mostly refused: what is written grows with the members, not their pairs."""
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(3000)]
    base = rng.choices(vocabulary, k=200)
    texts = []
    for _ in range(300):
        copy = list(base)
        for at in rng.sample(range(200), 5):
            copy[at] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    written = {}

    def counted(df, name, *rest):
        out = stage(df, name, *rest)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(neardup, "stage", counted)
    got = rows(neardup.near_duplicates(documents(list(enumerate(texts)))))
    assert got == brute(list(enumerate(texts)))
    # 44,850 pairs; a member stands in each of its 40 buckets at most twice.
    assert written["neardup-pairs"] <= 40 * 300 and written.get("neardup-blocks", 0) <= 2 * written["neardup-members"]
