"""Bounded samples of labelled rows, the only thing that classifiers are fitted on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; a NULL key falls in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def labels_by_key(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One label for each key: the commonest, 1 where they tie; rows without key or label do not count."""
    known = labels.select(key, F.col(label).cast("int").alias("label")).dropna()
    return known.groupBy(key).agg((F.avg("label") >= 0.5).cast("int").alias("label"))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int,
                    key: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """Rows (key, text, label) to fit on, and how many labelled keys each class has.

    `learn` says which keys may be learnt from. At most `per_class` keys of each class are taken, those with the
    smallest hash; so the list that is broadcast to pick their texts has at most twice that many entries.
    """
    known = labels_by_key(labels, key, label).filter(learn)
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    parts = [known.filter(F.col("label") == c).orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(per_class)
             for c in sorted(counts)]
    if not parts:
        return documents.select(key, text).limit(0).withColumn("label", F.lit(0)), counts
    chosen = reduce(DataFrame.unionByName, parts)
    return documents.select(key, text).join(F.broadcast(chosen), key), counts
