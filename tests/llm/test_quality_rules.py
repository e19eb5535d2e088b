import collections
import re

import pytest
from pyspark.sql import functions as F

from tablemargin.llm import quality_rules
from tablemargin.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SPACE = r"[\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in collections.Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return (*counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0])


def results(rows):
    return {r.doc_id: tuple(r[c] for c in [*quality_rules.COUNTS, "base_failed"]) for r in rows}


def test_query_against_brute_force(spark):
    got = QUERIES["op6_quality_rules"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert results(got) == {d.doc_id: brute(d.text) for d in docs}
    assert not any(r.kept and r.base_failed for r in got)


def test_odd_texts(documents):
    texts = [None, "", "   \n\t", "a b c d e", "a b c d e a b c d e", "x " * 400, "l m\nl m\n\n l m\nl m", "é ü\x0bñ\x1f z",
             "one two three four five six one two three four five one two three four", "# * $ % & | < >", "w" * 5000]
    judged = quality_rules.judge(documents(list(enumerate(texts)) + [(4, texts[4])]).withColumn("kept", F.lit("x")))
    rows = judged.collect()
    assert len(rows) == len(texts) + 1 and rows[0].lang == "en"
    assert results(rows) == {i: brute(t) for i, t in enumerate(texts)}


def test_empty_table(documents):
    assert quality_rules.judge(documents([])).count() == 0


def test_the_verdict_follows_the_labels(spark):
    judged = QUERIES["op6_quality_rules"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = judged.filter("n_words >= 10").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in rows}
    assert kept[1] > 0.97 and kept[0] < 0.1


def test_estimation_finds_the_reliable_rule():
    # Rules 0 and 1 object to the same documents; rule 2 objects at random.
    patterns = [((0, 0, 0), 800), ((0, 0, -1), 60), ((-1, -1, 0), 120), ((-1, -1, -1), 10), ((0, -1, 0), 5), ((-1, 0, 0), 5)]
    _, odds = quality_rules.estimate(patterns)
    assert odds[0][0] - odds[0][-1] > 3 and odds[1][0] - odds[1][-1] > 3 and abs(odds[2][0] - odds[2][-1]) < 1


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = quality_rules.counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "Exchange"))
