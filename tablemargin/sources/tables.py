"""Parquet tables by path or catalog name."""

from __future__ import annotations

import json
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablemargin.session import scratch_path, shared_dir, shuffles_deleted

#: What is broadcast at most where it is decided before the join (adaptive execution has the same limit).
BROADCAST_BYTES = 10 << 20
# Spark leaves out files whose name begins with an underscore when it reads a table.
SCHEMA_FILE = "_schema.json"


def write_table(
    df: DataFrame, path: str, partitions: list[str] | None = None, mode: str = "overwrite", **options
) -> None:
    """Materialize as Snappy Parquet, unless `options` name another compression.

    With `partitions` the rows are rebalanced on them first: a directory gets few files, and
    adaptive execution splits a directory too large for one task (one tenant may hold a third
    of all rows).  The shuffle files that made the rows go when they are written.
    """
    if partitions:
        df = df.hint("rebalance", *[F.col(c) for c in partitions])
    writer = df.write.mode(mode).options(**{"compression": "snappy", **options})
    if partitions:
        writer = writer.partitionBy(*partitions)
    with shuffles_deleted(df.sparkSession):
        writer.parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a Parquet table; columns added by later merges appear as NULL in older files.

    With a `schema` nothing is inferred; without one the footers are merged.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reader.parquet(path)


def stage(df: DataFrame, name: str, partitions: list[str] | None = None) -> DataFrame:
    """Write `df` once to the shared scratch folder and read it back.

    For results that are read several times: the lineage ends at files every executor can see,
    so neither a second reader nor a lost executor makes them be computed again.  They are compressed
    as the session says.
    """
    path = scratch_path(df.sparkSession, name)
    write_table(df, path, partitions, compression=df.sparkSession.conf.get("spark.sql.parquet.compression.codec"))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_sized(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`stage`, and how many bytes were written."""
    path = scratch_path(df.sparkSession, name)
    write_table(df, path, compression=df.sparkSession.conf.get("spark.sql.parquet.compression.codec"))
    return df.sparkSession.read.schema(df.schema).parquet(path), input_bytes(df.sparkSession, path)


def stage_to_join(df: DataFrame, name: str) -> DataFrame:
    """`stage`, with a broadcast hint where its measured rows are no more than adaptive execution would broadcast.

    Adaptive execution finds that out only when the other side's shuffle files are written already.
    """
    staged = stage(df, name)
    texts = [F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    found = staged.agg(F.count(F.lit(1)), *texts).first()
    # A row in memory: eight bytes a column and its texts.
    size = found[0] * 8 * (2 + len(df.columns)) + sum(found[1:])
    return F.broadcast(staged) if size <= BROADCAST_BYTES else staged


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if it exists."""
    fs, hpath = _hadoop_path(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _hadoop_path(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep a table's schema beside its files, so that it needs no footers and survives an empty table."""
    write_text(spark, f"{path}/{SCHEMA_FILE}", schema.json())


def saved_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema `save_schema` kept, or None."""
    path = f"{path}/{SCHEMA_FILE}"
    return T.StructType.fromJson(json.loads(read_text(spark, path))) if exists(spark, path) else None


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application staged; call it when its results are no longer read."""
    delete_path(spark, f"{shared_dir(spark)}/tablemargin-{spark.sparkContext.applicationId}")


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The catalog table, or an empty frame of `schema` while it does not exist yet."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def path_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at `path`, or an empty frame of `schema` while nothing is there."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop_path(spark, path)
    return fs.exists(hpath)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below `path`, from their metadata."""
    fs, hpath = _hadoop_path(spark, path)
    return fs.getContentSummary(hpath).getLength()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop_path(spark, path)
    fs.delete(hpath, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, hold = _hadoop_path(spark, old)
    _, hnew = _hadoop_path(spark, new)
    fs.mkdirs(hnew.getParent())
    if not fs.rename(hold, hnew):
        raise OSError(f"could not rename {old} to {new}")


def replace_table(df: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """Full refresh: write a new copy beside the table, then swap.

    Readers see the old table until the new one is complete, and `df` may read the table it
    replaces.  The old copy stays until the swap is done, so a failure loses nothing.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    fresh, old = f"{path}__new-{tag}", f"{path}__old-{tag}"
    write_table(df, fresh, partitions)
    save_schema(spark, fresh, df.schema)
    had_old = exists(spark, path)
    if had_old:
        rename(spark, path, old)
    try:
        rename(spark, fresh, path)
    except Exception:
        if had_old:
            rename(spark, old, path)
        raise
    if had_old:
        delete_path(spark, old)
