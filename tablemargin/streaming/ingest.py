"""File-incremental ingestion: every landed file is processed once and merged by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tablemargin.functions.naming import RUN_TIME_FORMAT, parse_bronze_filename
from tablemargin.operators import quality
from tablemargin.operators.merge import merge_replace
from tablemargin.schemas import ENDPOINT_SCHEMAS
from tablemargin.session import scratch_scope
from tablemargin.sources.bronze import CORRUPT, with_corrupt
from tablemargin.sources.tables import stage


def stream_bronze(
    spark: SparkSession, root: str, endpoint: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of one endpoint's documents from directories made by `write_bronze`.

    A document that does not parse has its text in `_corrupt_record`, as in `read_bronze`.
    """
    reader = spark.readStream.schema(
        "payload string, endpoint string, merchant_id string, year int, month int, day int, run_ts string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(root).where(F.col("endpoint") == endpoint)
    return raw.select(
        F.col("merchant_id").alias("path_merchant_id"),
        F.make_date("year", "month", "day").alias("path_date"),
        F.to_timestamp_ntz("run_ts", F.lit(RUN_TIME_FORMAT)).alias("run_timestamp_utc"),
        F.from_json("payload", with_corrupt(ENDPOINT_SCHEMAS[endpoint]), {"columnNameOfCorruptRecord": CORRUPT}).alias("doc"),
    ).select("path_merchant_id", "path_date", "run_timestamp_utc", "doc.*")


def stream_bronze_files(
    spark: SparkSession, root: str, endpoint: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of one endpoint's documents stored as one JSON file each."""
    schema = ENDPOINT_SCHEMAS[endpoint]
    reader = spark.readStream.schema(with_corrupt(schema, path_columns=True)).options(
        multiLine=True, pathGlobFilter=f"{endpoint}-*.json", columnNameOfCorruptRecord=CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(root).select(
        F.col("merchant_id").alias("path_merchant_id"),
        F.make_date("year", "month", "day").alias("path_date"),
        parse_bronze_filename("_metadata.file_name").run_timestamp_utc.alias("run_timestamp_utc"),
        *schema.fieldNames(), CORRUPT)


def stream_merge(
    stream: DataFrame, path: str, keys: list[str], partitions: list[str], checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch, *, version: str,
) -> StreamingQuery:
    """Merge everything that has landed so far into the table at `path`, then stop.

    `transform` turns a micro-batch of documents into table rows.  The merge replaces whole keys,
    so a batch that is replayed after a failure leaves the same table.  `version` names the column of
    the run time: a file that arrives late does not replace a newer run, and of several runs in one
    batch the latest counts.  A batch with a document that does not parse stops the stream before it
    is merged; it is read again once the file is mended.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            if CORRUPT in batch.columns:
                batch = stage(batch, "stream-batch")
                quality.enforce(quality.run_checks(batch, "stream", [quality.document_parsed()]))
            merge_replace(path, transform(batch), keys, partitions, version=version)

    return (stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
