import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tablemargin.llm import decontaminate
from tablemargin.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
RESULTS = decontaminate.RESULTS


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])] - {None}
        ids = sorted(map(str, found))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r[c] for c in ("doc_id", *RESULTS)) for r in df.collect()), key=str)


def test_query_against_brute_force(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [(b.item_id, b.text) for b in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = rows(QUERIES["op7_decontaminate"](spark, SF_DIR))
    assert got == brute(docs, items) and any(r[2] for r in got)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_planted_passages_both_ways(spark, documents, broadcast_bytes):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["the"] * 30
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 9, 10, 11, 25])))) for i in range(25)]
    items += [(3, items[3][1]), (90, None), (91, ""), (92, " ,;"), (None, "solo null item")]
    docs = []
    for i in range(60):
        body = rng.choices(vocabulary, k=rng.randint(0, 80))
        if i % 3:
            at = rng.randint(0, len(body))
            body[at:at] = rng.choice(items[:25])[1].upper().split()
        docs.append((i, ", ".join(body)))
    docs += [(7, docs[7][1]), (100, None), (101, ""), (102, "x Solo-null ITEM!"), (103, "the " * 300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents(docs).withColumn("n_hit", F.lit("clash"))
    got = decontaminate.decontaminate(df, bench, broadcast_bytes=broadcast_bytes)
    assert rows(got) == brute(docs, items) and "lang" in got.columns


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in decontaminate.decontaminate(documents([(1, "a b c")]), none).collect()] == [False]
    assert decontaminate.decontaminate(documents([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
