"""Registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablemargin.llm import (
    bpe, classlm, decontaminate, html_extract, licenses, neardup, oracles, periodic, prefix_trie, quality_mil, quality_rules, repeats,
    toxicity, urlfilter)
from tablemargin.llm.batches import bounded_batches
from tablemargin.sources.tables import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op3_near_duplicates": oracles.NEAR_DUPLICATES, "op7_decontaminate": oracles.DECONTAMINATE,
                           "op12_repeated_passages": oracles.REPEATS, "op13_prefix_trie": oracles.TRIE}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(bounded_batches(spark), sf_dir)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "n_toxic_tokens", "toxic_spans")


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_mil.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = quality_rules.counts(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    judged = quality_rules.judge_counts(stage(counted, "quality-counts"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "posterior")


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                       table(spark, sf_dir, "benchmark"), keep_text=False)


@query
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


@query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classlm.score(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), rebuild=True)


@query
def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))
