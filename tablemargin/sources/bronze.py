"""Landing zone: validate, write and read raw marketplace payloads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablemargin.functions.naming import ENDPOINTS, MERCHANT_ID_PATTERN, RUN_TIME_FORMAT, parse_bronze_filename
from tablemargin.schemas import ENDPOINT_SCHEMAS
from tablemargin.session import shuffles_deleted

# Parts that landing rows are written in, one after the other: only one part's payloads are in shuffle files at a time.
PARTS = 4
# One directory per merchant, day and run fences the tenants; with very many small merchants,
# `DAILY` keeps the number of directories independent of theirs.
FENCED = ["endpoint", "merchant_id", "year", "month", "day", "run_ts"]
DAILY = ["endpoint", "year", "month", "day"]
CORRUPT = "_corrupt_record"


def landing_error() -> Column:
    """Reason a landing row is refused, or NULL."""
    return (
        F.when(~F.coalesce(F.col("merchant_id").rlike(MERCHANT_ID_PATTERN), F.lit(False)), "BAD_MERCHANT_ID")
        .when(~F.coalesce(F.col("endpoint").isin(*ENDPOINTS), F.lit(False)), "BAD_ENDPOINT")
        .when(F.col("target_date").isNull(), "BAD_TARGET_DATE")
    )


def validate_landing(df: DataFrame, today: dt.date | Column) -> tuple[DataFrame, DataFrame]:
    """Split landing rows into (accepted, rejects).

    Accepted rows gain `far_future`, true when the target date lies more than one day after
    `today` (a warning only); rejects gain `reject_reason`.
    """
    day = today if isinstance(today, Column) else F.lit(today)
    checked = df.withColumn("reject_reason", landing_error())
    accepted = checked.where(F.col("reject_reason").isNull()).drop("reject_reason").withColumn(
        "far_future", F.col("target_date") > F.date_add(day, 1))
    return accepted, checked.where(F.col("reject_reason").isNotNull())


def write_bronze(payloads: DataFrame, root: str, partitions: list[str] = FENCED) -> None:
    """Append payload rows unchanged below `root`.

    Columns: merchant_id, endpoint, target_date, run_timestamp_utc, payload.  The payload is kept
    as one string; what is not in `partitions` becomes a column, and `read_bronze` reads either.
    It may be a VARIANT too, with `_corrupt_record` beside it (`variant.write_variant`).
    A later run of the same day adds files and never replaces any.  The rebalance brings small
    directories together and splits the ones that are too large for one task; rows are sorted by
    merchant within a file, so that one tenant's can be skipped to.  A directory is in one part of
    `PARTS`; `payloads` is read once for each, so stage it first if it is costly to compute.  Files
    are compressed as the session says.
    """
    day = F.col("target_date")
    laid_out = payloads.select(
        "endpoint", "merchant_id",
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        F.date_format("run_timestamp_utc", RUN_TIME_FORMAT).alias("run_ts"),
        "payload", *[c for c in (CORRUPT,) if c in payloads.columns],
    )
    part = F.pmod(F.xxhash64(*partitions), F.lit(PARTS))
    with shuffles_deleted(payloads.sparkSession):
        for k in range(PARTS):
            spread = laid_out.where(part == k).hint("rebalance", *[F.col(c) for c in partitions])
            (spread.sortWithinPartitions(*partitions, *[c for c in ("merchant_id", "run_ts") if c not in partitions])
                .write.mode("append").partitionBy(*partitions).parquet(root))


def write_report_pair(jobs: DataFrame, root: str) -> None:
    """Land request and result of report jobs under one run time each.

    Columns: merchant_id, target_date, run_timestamp_utc, request_payload, result_payload.
    """
    both = F.array(
        F.struct(F.lit("reports_enqueue").alias("endpoint"), F.col("request_payload").alias("payload")),
        F.struct(F.lit("reports_result").alias("endpoint"), F.col("result_payload").alias("payload")),
    )
    write_bronze(
        jobs.select("merchant_id", "target_date", "run_timestamp_utc", F.inline(both)), root)


def read_bronze(
    spark: SparkSession, source: str, endpoint: str, layout: str = "landing", modified_after: str | None = None
) -> DataFrame:
    """Read one endpoint's documents with their landing columns.

    layout = "landing"  directories made by `write_bronze`
             "files"    one JSON document per file, merchant_id=/year=/month=/day=/{endpoint}-{run}.json
             "table"    `source` is a table whose columns are already those of the documents

    Adds merchant partition columns as `path_merchant_id`, `path_date`, `run_timestamp_utc`
    ("landing" and "files"), and `landing_file`, by which `build` knows what it has processed.
    Fields a document lacks are NULL; a document that does not parse has its text in
    `_corrupt_record` (see `bronze_rejects`).  With `modified_after` (a UTC time) files that are
    older are not opened: see `Warehouse.landing_mark`.
    """
    if endpoint not in ENDPOINT_SCHEMAS:
        raise ValueError(f"unknown endpoint {endpoint!r}")
    schema = ENDPOINT_SCHEMAS[endpoint]
    if layout == "table":
        return spark.table(source)
    if layout == "landing":
        doc = F.from_json("payload", with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT})
        return landed_documents(landing_rows(spark, source, endpoint, "payload string", modified_after), doc)
    if layout == "files":
        files = _reader(spark, modified_after).schema(with_corrupt(schema, path_columns=True)).options(
            multiLine=True, pathGlobFilter=f"{endpoint}-*.json", columnNameOfCorruptRecord=CORRUPT).json(source)
        return files.select(
            F.col("merchant_id").alias("path_merchant_id"), F.make_date("year", "month", "day").alias("path_date"),
            parse_bronze_filename("_metadata.file_name").run_timestamp_utc.alias("run_timestamp_utc"),
            F.col("_metadata.file_path").alias("landing_file"), *schema.fieldNames(), CORRUPT,
        )
    raise ValueError(f"unknown layout {layout!r}")


def _reader(spark: SparkSession, modified_after: str | None):
    return spark.read.options(modifiedAfter=modified_after, timeZone="UTC") if modified_after else spark.read


def landing_rows(
    spark: SparkSession, source: str, endpoint: str, columns: str, modified_after: str | None = None
) -> DataFrame:
    """An endpoint's rows in the directories made by `write_bronze`, which hold `columns` beside the landing columns."""
    return _reader(spark, modified_after).schema(
        f"{columns}, endpoint string, merchant_id string, year int, month int, day int, run_ts string"
    ).parquet(source).where(F.col("endpoint") == endpoint)


def landed_documents(rows: DataFrame, doc: Column) -> DataFrame:
    """Landing columns, and the fields of the struct `doc` made from the payload."""
    return rows.select(
        F.col("merchant_id").alias("path_merchant_id"), F.make_date("year", "month", "day").alias("path_date"),
        F.to_timestamp_ntz("run_ts", F.lit(RUN_TIME_FORMAT)).alias("run_timestamp_utc"),
        F.col("_metadata.file_path").alias("landing_file"), doc.alias("doc"),
    ).select("path_merchant_id", "path_date", "run_timestamp_utc", "landing_file", "doc.*")


def with_corrupt(schema, path_columns: bool = False):
    extra = [T.StructField(CORRUPT, T.StringType())]
    if path_columns:
        extra += [T.StructField("merchant_id", T.StringType())]
        extra += [T.StructField(name, T.IntegerType()) for name in ("year", "month", "day")]
    return T.StructType(list(schema.fields) + extra)


def bronze_rejects(bronze: DataFrame) -> DataFrame:
    """Documents that did not parse, with where they came from."""
    return bronze.where(F.col(CORRUPT).isNotNull()).select(
        "path_merchant_id", "path_date", "run_timestamp_utc", CORRUPT)


def strip_provenance(df: DataFrame, columns: tuple[str, ...] = ("source", "version", "endpoint")) -> DataFrame:
    """Drop fixture metadata that is not part of a marketplace payload."""
    return df.drop(*columns)


def incomplete_pages(bronze: DataFrame) -> DataFrame:
    """Documents whose `next_cursor` says more pages exist."""
    return bronze.where(F.col("next_cursor").isNotNull())
