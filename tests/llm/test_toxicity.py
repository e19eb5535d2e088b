import numpy as np
from pyspark.sql import functions as F

from tablemargin.llm import toxicity
from tablemargin.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    scored = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = scored.filter("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    share = {r.toxic: r.p for r in rows}
    # Toxic words of three languages begin like ordinary ones there, and there are few labels.
    assert share[1] > 0.65 and share[0] < 0.02
    assert scored.count() == 10000 and scored.filter("score between 0 and 1").count() == 10000


def brute_marginals(weight, step):
    n = len(weight)
    p, total = np.zeros(n), 0.0
    for state in range(1 << n):
        y = [(state >> i) & 1 for i in range(n)]
        s = np.exp(sum(w for w, b in zip(weight, y) if b) + sum(step[a, b] for a, b in zip(y, y[1:])))
        total += s
        p += s * np.array(y)
    return p / total


def test_marginals_against_enumeration():
    rng = np.random.default_rng(3)
    field = toxicity.ChainField()
    field.step = rng.normal(size=(2, 2))
    lengths = np.array([1, 5, 3, 8])
    weight = rng.normal(size=lengths.sum())
    want = np.concatenate([brute_marginals(w, field.step) for w in np.split(weight, np.cumsum(lengths)[:-1])])
    assert np.allclose(field.marginals(weight, lengths), want)


def test_spans_are_offsets_of_runs():
    assert toxicity.spans("a  bad word\nhere", np.array([0.1, 0.9, 0.8, 0.2])) == [(3, 11)]


def make(spark, documents):
    names = "rose oak elm fern moss reed sage mint dill leek".split()
    docs = [(i, f"The {names[i % 10]} was " + (f"a stupid {names[i // 3 % 10]} and a clown {names[i // 7 % 10]}" if i % 4 == 0 else "kind to us") + f" today. Item x{i}.")
            for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)] + [(3, 1, 0), (None, 1, 1), (5, 1, None)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def test_odd_rows_and_spans(spark, documents):
    docs, labels = make(spark, documents)
    docs += [(500, None), (501, ""), (502, "what a Stupid, clown thing"), (502, "what a Stupid, clown thing"), (503, "word " * 30000)]
    rows = toxicity.classify(documents(docs).withColumn("score", F.lit("x")), labels).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) and by_id[502].lang == "en"
    assert by_id[502].predicted == 1 and all(by_id[i].predicted == 0 for i in (500, 501, 503, 1, 2))
    text = "what a Stupid, clown thing"
    assert "Stupid" in "".join(text[s.begin:s.end] for s in by_id[502].toxic_spans)


def test_no_labels_and_no_documents(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in toxicity.classify(documents([(1, "a b")]), none).collect()] == [0.5]
    _, labels = make(spark, documents)
    assert toxicity.classify(documents([]), labels).count() == 0
