import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tablemargin.sources.tables import exists
from test_decontaminate import brute as brute_hits
from test_neardup import brute as brute_groups

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, function in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stage(function(spark, out[-1], SF_DIR), "test"))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns


def test_classified_stages_follow_the_labels(spark, steps):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = ids(labels.filter("quality = 1"))
    left = ids(steps[2])
    long_enough = ids(steps[0].filter(F.size(F.split("text", r"\s+")) >= 12))
    assert len((good & long_enough) - left) <= 0.02 * len(good)
    assert len(ids(labels.filter("quality = 0")) & left) <= 2


def test_one_document_of_each_group_stays(steps):
    docs = [(r.doc_id, r.text) for r in steps[2].collect()]
    assert ids(steps[3]) == {d for d, n, _, kept in brute_groups(docs, 5) if kept}


def test_contaminated_documents_go(spark, steps):
    docs = [(r.doc_id, r.text) for r in steps[3].collect()]
    items = [(b.item_id, b.text) for b in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert ids(steps[4]) == {r[0] for r in brute_hits(docs, items) if not r[2]}


def test_tokens_are_the_library_s(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    got = steps[5].collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.token_ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.token_ids)


def test_run_gives_the_last_stage(spark, steps):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == steps[5].columns
    assert ids(got) == ids(steps[5])


def test_repeated_rows_leave_one(spark, documents):
    text = "one two three four five six seven"
    df = documents([(1, text), (1, text), (2, text), (3, None), (None, "alone here now"), (None, text)])
    got = corpus_pipeline.near_duplicates_stage(spark, df, SF_DIR).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "3", "None"]


def test_groups_without_doc_id_leave_one(spark, documents):
    words = [f"w{i}" for i in range(60)]
    near = [" ".join(words), " ".join(words[:-1] + ["other"])]
    df = documents([(None, near[0])] * 5 + [(None, near[1])] * 3 + [(None, "alone here now")] * 4 + [(None, None), (None, ""), (7, "some other text at all"), (7, "")])
    got = corpus_pipeline.near_duplicates_stage(spark, df, SF_DIR).collect()
    want = [(None, near[1]), (None, "alone here now"), (None, None), (None, ""), (7, "some other text at all"), (7, "")]
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t)) for i, t in want)


def test_folds_agree_with_zlib(spark):
    from tablemargin.llm.samples import fold
    got = spark.range(-5, 50).select("id", fold(F.col("id"), 7).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 7 for r in got)


def test_a_stage_deletes_what_the_one_before_it_staged(spark):
    """Once that one's result is written; what a result still reads stays."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    for i, (name, function) in enumerate(corpus_pipeline.STAGES[:4]):
        lazy = function(spark, docs, sf_dir)
        paths = corpus_pipeline._staged[name]
        docs = corpus_pipeline.stage(lazy, "test")
        if i < 3:
            after = corpus_pipeline.STAGES[i + 1][1]
            after(spark, lazy, sf_dir).count()
            assert lazy.count() == docs.count()
            corpus_pipeline._staged[name] = paths
            after(spark, docs, sf_dir).count()
            assert not any(exists(spark, p) for p in paths)
    assert names == ["quality_rules", "quality_classifier", "near_duplicates", "decontamination", "bpe_tokens"]
