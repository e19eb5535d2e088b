import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tablemargin.llm import quality_mil
from tablemargin.llm.batches import Words
from tablemargin.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    scored = QUERIES["op9_quality"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = scored.filter("held_out").join(labels, "doc_id").groupBy("quality").agg(F.avg("predicted").alias("p")).collect()
    share = {r.quality: r.p for r in rows}
    assert share[1] > 0.98 and share[0] < 0.1
    assert scored.count() == 10000 and scored.filter("score between 0 and 1").count() == 10000


def test_gradient_against_differences():
    rng = np.random.default_rng(1)
    x, offsets = rng.normal(size=(9, quality_mil.FEATURES)), np.array([0, 2, 3, 9])
    y, weight = np.array([1.0, 0, 1]), np.array([0.5, 0.2, 0.3])
    net = quality_mil.GatedAttention()
    grads = net.gradient(net.forward(x, offsets), y, weight, offsets[:-1])

    def loss():
        s = net.forward(x, offsets)["score"]
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()

    for name, value in net.p.items():
        at = (0,) * value.ndim
        value[at] += 1e-5
        up = loss()
        value[at] -= 2e-5
        down = loss()
        value[at] += 1e-5
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-6, name


def test_every_passage_counts():
    words = Words(pa.array(["a b " * 100, None, "", "X1 !! #"]))
    x, offsets = quality_mil.passages(words)
    assert offsets.tolist() == [0, 4, 5, 6, 7]
    assert not x[4:6].any()
    assert np.isclose(x[0][8], 2 / 64) and np.isclose(x[6][4], 1 / 5) and np.isclose(x[6][2], 1 / 5)


def test_odd_rows(spark, documents):
    good, bad = "It was a fine day and we all went out to see the old town. ", "BUY!! NOW!! ### $$$ "
    docs = [(i, (good if i % 3 else bad) * (1 + i % 7)) for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(90)] + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs += [(200, None), (201, ""), (202, good * 3000), (203, bad * 20), (203, bad * 20)]
    rows = quality_mil.classify(documents(docs).withColumn("predicted", F.lit("x")), labels).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) and by_id[202].predicted == 1 and by_id[203].predicted == 0
    assert by_id[200].score == by_id[201].score and 0 <= by_id[200].score <= 1


def test_no_labels_and_no_documents(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality_mil.classify(documents([(1, "a b")]), none).collect()] == [0.5]
    some = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality_mil.classify(documents([]), some).count() == 0
