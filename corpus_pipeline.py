"""From raw documents to token ids: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablemargin.llm import bpe, decontaminate, neardup, quality_mil, quality_rules
from tablemargin.llm.batches import bounded_batches
from tablemargin.llm.samples import fold
from tablemargin.session import delete_scratch, scratch_noted
from tablemargin.sources.tables import stage

#: The near-duplicate stage compares runs of five words.
SHINGLE, SIMILARITY = 5, 0.8
#: Documents below this probability of being of quality 1 go.
QUALITY_FROM = 0.3
TOKENIZER = "byte_bpe_50k.json"
#: Words an encoder keeps and characters it learns at once: less than on its own, as the workers of four stages came before.
BOUNDS = {"cached": 100_000, "slice_chars": 256 << 10}


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the weakly supervised rules keep."""
    return quality_rules.judge(docs).filter("kept").select(docs.columns)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the passage network, fitted outside the held-out fold, finds good enough."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_mil.train(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return docs.withColumn("_score", quality_mil.score_column(model, F.col("text"))).filter(F.col("_score") >= QUALITY_FROM).drop("_score")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group, the one with the smallest doc_id.

    Of repeated rows of that doc_id, and of a group whose rows all lack doc_id, the smallest row stays. Documents without
    words are no group.
    """
    found = neardup.near_duplicates(docs, shingle=SHINGLE, threshold=SIMILARITY, root="_root")
    found = found.filter(F.col("kept") | F.col("component_id").isNull() | F.col("_root").isNull())
    found = stage(found, "pipeline-representatives")
    # Rows are told by their doc_id, those without one by their group's root.
    group = [F.col("doc_id").alias("_id"), F.when(F.col("doc_id").isNull(), F.col("_root")).alias("_group")]
    same = [F.col("_id").eqNullSafe(F.col("r_id")), F.col("_group").eqNullSafe(F.col("r_group"))]
    worded = found.filter("_root is not null").select(*docs.columns, *group)
    repeated = worded.groupBy("_id", "_group").count().filter("count > 1").select(F.col("_id").alias("r_id"), F.col("_group").alias("r_group"))
    first = worded.join(repeated, same, "left_semi").groupBy("_id", "_group").agg(F.min(F.struct(*docs.columns)).alias("row"))
    rest = found.filter("_root is null").select(docs.columns).unionByName(worded.join(repeated, same, "left_anti").select(docs.columns))
    return rest.unionByName(first.select("row.*").select(docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark).filter(~F.col("contaminated")).select(docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digests of the ids and of what they decode to."""
    path = public_tokenizers.path(TOKENIZER)
    encoded = bpe.decode_ids(bpe.encode_texts(docs.select("doc_id", "lang", "source", "text"), path, **BOUNDS), path, **BOUNDS)
    return encoded.select("doc_id", "lang", "source", "token_ids", *bpe.digest_columns())


#: What each stage has staged and its result may still read, by the stage's name.
_staged: dict[str, list[str]] = {}


def _bounded(name: str, after: str | None, function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with Arrow batches of a few MB, so that five stages fit into the workers' memory one after the other.

    It begins by deleting what the stage before it staged: that one's result is written by now. What `docs` still reads stays.
    """
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if before := _staged.pop(after, None):
            files = docs.inputFiles()
            delete_scratch(spark, [p for p in before if not any(f"/{p.rsplit('/', 1)[-1]}/" in f for f in files)])
        with scratch_noted() as paths:
            out = function(bounded_batches(spark), docs, sf_dir)
        _staged[name] = paths
        return out

    return bounded


_NAMED = [("quality_rules", quality_rules_stage), ("quality_classifier", quality_classifier_stage),
          ("near_duplicates", near_duplicates_stage), ("decontamination", decontamination_stage), ("bpe_tokens", tokens_stage)]
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    (name, _bounded(name, after, function)) for (name, function), after in zip(_NAMED, [None, *(n for n, _ in _NAMED)])]

#: Fitted models and ids are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
