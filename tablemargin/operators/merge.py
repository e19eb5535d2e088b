"""Keyed merges into Parquet tables, which have no MERGE of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablemargin.operators.incremental import latest_run_wins
from tablemargin.session import scratch_scope
from tablemargin.sources.tables import (
    _hadoop_path, exists, input_bytes, replace_table, save_schema, saved_schema, stage, write_table)

#: Partitions are merged in parts, one after the other: one for each so many bytes of the table and what comes in, at most MOST_PARTS.
PART_BYTES, MOST_PARTS = 32 << 20, 4


def _key(keys: list[str]) -> Column:
    """The key as one struct: never NULL itself, and NULL fields equal NULL fields."""
    return F.struct(*keys)


def _match(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    # Distinct first, as the join can split a hot key on its left side only; grouping by the
    # struct that is joined on leaves the right side partitioned for the join.
    wanted = other.select(_key(keys).alias("_key")).distinct()
    return df.join(wanted, _key(keys) == F.col("_key"), how)


def without_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` whose key is not in `other`; NULL keys match NULL keys."""
    return _match(df, other, keys, "left_anti")


def with_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` whose key is in `other`; NULL keys match NULL keys."""
    return _match(df, other, keys, "left_semi")


def replace_by_key(target: DataFrame, source: DataFrame, keys: list[str], evolve: bool = False) -> DataFrame:
    """`target` with every row of an incoming key removed and all rows of `source` added.

    Several rows may share a key (the lines of an order).  With `evolve` columns missing on
    either side are NULL there.
    """
    return without_keys(target, source, keys).unionByName(source, allowMissingColumns=evolve)


def delete_by_key(target: DataFrame, keys_to_delete: DataFrame, keys: list[str]) -> DataFrame:
    """`target` without the given keys; a key that is not there is no error."""
    return without_keys(target, keys_to_delete, keys)


def last_edits(edits: DataFrame) -> DataFrame:
    """The last edit of each (merchant, SKU).

    Edits of the same instant are ordered by their costs, so the outcome does not depend on task order.
    """
    last = edits.groupBy("merchant_id", "line_item_sku").agg(
        F.max(F.struct("updated_at", "recipe_cost", "packaging_cost")).alias("e"))
    return last.select(
        "merchant_id", "line_item_sku", F.col("e.recipe_cost").alias("recipe_cost"),
        F.col("e.packaging_cost").alias("packaging_cost"), F.col("e.updated_at").alias("updated_at"))


def upsert_cogs(target: DataFrame, edits: DataFrame) -> DataFrame:
    """The cost ledger after a batch of edits, several of which may be of one (merchant, SKU)."""
    return replace_by_key(
        target, last_edits(edits).select(*target.columns), ["merchant_id", "line_item_sku"])


def delete_cogs(target: DataFrame, keys_to_delete: DataFrame) -> DataFrame:
    return delete_by_key(target, keys_to_delete, ["merchant_id", "line_item_sku"])


def keep_newest(source: DataFrame, target: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Source rows that are not older than what the target already holds for their key."""
    held = target.groupBy(_key(keys).alias("_key")).agg(F.max(version).alias("_held"))
    return source.join(held, (_key(keys) == F.col("_key")) & (F.col("_held") > F.col(version)), "left_anti")


def target_schema(spark: SparkSession, path: str, source: DataFrame, evolve: bool) -> T.StructType:
    """Schema to read the target with: its own columns, typed as in `source` where both have them.

    The table's columns are those saved beside it.  Only a table from elsewhere has none saved: then
    the footers tell, or, if it holds no file yet, `source`.  The types come from `source`, so
    partition values such as "007" are not read as numbers.
    """
    held = saved_schema(spark, path)
    if held is None:
        try:
            held = spark.read.option("mergeSchema", "true").parquet(path).schema
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            held = source.schema
    if not evolve and set(held.names) != set(source.columns):
        raise ValueError(
            f"columns differ from the table's: {sorted(set(held.names) ^ set(source.columns))}; use evolve=True")
    typed = {f.name: f for f in source.schema}
    return T.StructType([typed.get(f.name, f) for f in held])


def merge_replace(
    path: str, source: DataFrame, keys: list[str], partitions: list[str],
    evolve: bool = False, keys_move: bool = True, version: str | None = None, clear: DataFrame | None = None,
    settled: bool = False,
) -> None:
    """Merge `source` into the Parquet table at `path`, replacing whole keys.

    Keys in `clear` lose the rows they have, too, whether or not `source` has new ones for them.

    Only the partitions that hold an incoming key, before or after, are rewritten.
    1. `source` is staged, since it is read several times and may read the table itself.
    2. Affected partitions are those of the source plus those of matching target rows.  With
       `keys_move=False` a key never changes partition and the target need not be searched.
    3. Survivors and source rows are staged, large merges in parts of whole partitions, then written
       with dynamic partition overwrite.  The staged copy outlives a failure half way, and repeating the merge gives the same table.
    4. Dynamic overwrite leaves a partition alone that receives no rows, so those that became
       empty are deleted.
    `version` names a column (a run time).  A source key older than the target's is ignored, and of
    several versions of a key in the source only the latest counts; `clear` needs that column then.
    A `settled` source is staged by the caller already and holds one version of each key, so neither is done again.
    """
    with scratch_scope(source.sparkSession):
        _merge_replace(path, source, keys, partitions, evolve, keys_move, version, clear, settled)


def _merge_replace(path, source, keys, partitions, evolve, keys_move, version, clear, settled) -> None:
    spark = source.sparkSession
    incoming = source if settled else stage(source, "merge-in")
    if version and not settled:
        incoming = latest_run_wins(incoming, keys, version)
    parts = _parts(incoming, path) if partitions else 1
    part = F.pmod(F.xxhash64(*partitions), F.lit(parts)) if partitions else F.lit(0)
    if not exists(spark, path):
        for k in range(parts):
            write_table(incoming.where(part == k) if parts > 1 else incoming, path, partitions, "append" if k else "overwrite")
        save_schema(spark, path, incoming.schema)
        return
    schema = target_schema(spark, path, source, evolve)
    target = spark.read.schema(schema).parquet(path)
    # A row for each key and partition: which keys count and where they go is decided on these, not on whole rows.
    named = list(dict.fromkeys([*keys, *([version] if version else []), *partitions]))
    arriving = stage(incoming.select(*named).distinct(), "merge-keys")
    wanted = arriving
    if clear is not None:
        wanted = wanted.unionByName(clear.select(*keys, *([version] if version else [])), allowMissingColumns=True)

    after = T.StructType([*schema, *[f for f in source.schema if f.name not in schema.names]])
    if not partitions:
        if version:
            held = with_keys(target, wanted, keys)
            held = stage(held.groupBy(*keys).agg(F.max(version).alias(version)), "merge-held")
            incoming, wanted = (keep_newest(x, held, keys, version) for x in (incoming, wanted))
        replace_table(without_keys(target, wanted, keys).unionByName(incoming, allowMissingColumns=evolve), path)
        return

    fixed = [p for p in partitions if p in keys]
    searched = prune(target, incoming, partitions) if not keys_move and clear is None else prune(target, wanted, fixed)
    matched = with_keys(searched, wanted, keys)
    if version or keys_move or clear is not None:
        # Searched once: what the table holds of these keys, a row for each key, version and partition.
        matched = stage(matched.select(*named).distinct(), "merge-held")
    if version:
        incoming, arriving, wanted = (keep_newest(x, matched, keys, version) for x in (incoming, arriving, wanted))
    affected = arriving.select(*partitions)
    if keys_move or clear is not None:
        affected = affected.unionByName(matched.select(*partitions))
    affected = stage(affected.distinct(), "merge-parts")

    merged = []
    for k in range(parts):
        here, new, held = ((x.where(part == k) if parts > 1 else x) for x in (affected, incoming, target))
        touched = with_keys(prune(held, here, partitions), here, partitions)
        merged.append(stage(without_keys(touched, wanted, keys).unionByName(new, allowMissingColumns=evolve), "merge-out", partitions))
    staged = reduce(DataFrame.unionByName, merged)
    save_schema(spark, path, after)
    # The staged files already hold one partition each, so this write needs no shuffle.
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy(*partitions).parquet(path))

    emptied = without_keys(affected, staged, partitions)
    drop_partitions(spark, path, schema, emptied, partitions)


def _parts(source: DataFrame, path: str) -> int:
    """In how many parts staged rows are merged into the table: the shuffle files of one part at a time are on disk."""
    spark = source.sparkSession
    folders = [f for f in {f.rsplit("/", 1)[0] for f in source.inputFiles()} | {path} if exists(spark, f)]
    return max(1, min(MOST_PARTS, sum(input_bytes(spark, f) for f in folders) // PART_BYTES))


def prune(df: DataFrame, wanted: DataFrame, columns: list[str]) -> DataFrame:
    """Narrow `df` to the partitions whose values occur in `wanted`.

    A superset of the wanted rows: the exact choice is left to a join.  The smallest and largest
    wanted values prune statically, the distinct ones at run time.  These are broadcast: there are
    at most as many as the table has, or is getting, directories, and the planner lists those
    anyway.  However many there are, no list of literals is made.
    """
    if not columns:
        return df
    ends = wanted.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))],
                      *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]).first()
    within = [F.col(c).between(F.lit(ends[f"lo_{c}"]), F.lit(ends[f"hi_{c}"])) for c in columns if ends[f"lo_{c}"] is not None]
    if len(within) < len(columns):
        return df
    inside = reduce(Column.__and__, within)
    found = df.where(inside).join(F.broadcast(wanted.select(*columns).where(inside).distinct()), columns, "left_semi")
    missing = [F.col(c).isNull() for c in columns]
    if any(ends[f"null_{c}"] for c in columns):
        found = found.unionByName(df.where(reduce(Column.__or__, missing)))
    return found


def drop_partitions(
    spark: SparkSession, path: str, schema: T.StructType, gone: DataFrame, partitions: list[str]
) -> None:
    """Delete the directories of the given partitions; only their paths reach the driver."""
    held = spark.read.schema(schema).parquet(path).select(*partitions, F.col("_metadata.file_path").alias("file"))
    files = prune(held, gone, partitions).distinct()
    folders = with_keys(files, gone, partitions).select(
        F.regexp_replace("file", "/[^/]+$", "").alias("folder")).distinct()
    for row in folders.toLocalIterator():
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
            spark.sparkContext._jvm.java.net.URI(row.folder))
        fs, _ = _hadoop_path(spark, path)
        fs.delete(hpath, True)
