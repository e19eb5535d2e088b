"""Report jobs: request and result documents to one row per job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablemargin.functions.money import tidy_currency
from tablemargin.functions.times import local_date, utc_ntz
from tablemargin.operators.incremental import latest_row


def join_reports(enqueue: DataFrame, result: DataFrame) -> DataFrame:
    """Requests with their result, if any, by job id.

    Both sides are first reduced to each job's latest document, so landing a job again adds no
    rows and a job is one row.
    Result columns are prefixed `r_`.
    """
    left = latest_row(enqueue, ["jobId"], "run_timestamp_utc")
    right = latest_row(result, ["jobId"], "run_timestamp_utc")
    right = right.select("jobId", *[F.col(c).alias(f"r_{c}") for c in right.columns if c != "jobId"])
    return left.join(right, "jobId", "left")


def flat_requests(documents: DataFrame) -> DataFrame:
    """Request documents as flat rows.  Those without a job id belong to none."""
    return documents.where("jobId is not null").select(
        F.col("jobId").alias("job_id"), "run_timestamp_utc", "path_merchant_id", "path_date",
        F.col("status").alias("enqueue_status"), _utc(documents, "created_at").alias("created_at"))


def flat_results(documents: DataFrame) -> DataFrame:
    """Result documents as flat rows."""
    totals = "result.totals"
    return documents.where("jobId is not null").select(
        F.col("jobId").alias("job_id"), "run_timestamp_utc", F.col("status").alias("result_status"), "result.store_id",
        _utc(documents, "result.period_start").alias("result_period_start"), _utc(documents, "result.period_end").alias("result_period_end"),
        *[column.alias(f"{kind}_{part}") for kind in ("gross_sales", "net_payout") for part, column in (
            ("amount", F.col(f"{totals}.{kind}.amount").cast("bigint")), ("currency", tidy_currency(f"{totals}.{kind}.currency")))])


def newer_half(held: DataFrame, new: DataFrame) -> DataFrame:
    """A row for each job in `new`: of what was held and what is new, whatever came first, that of the latest run."""
    known = held.join(new.select("job_id").distinct(), "job_id", "left_semi")
    return latest_row(known.unionByName(new), ["job_id"], "run_timestamp_utc")


def report_rows(requests: DataFrame, results: DataFrame, tz: str | Column = "UTC") -> DataFrame:
    """One row for each requested job; a result without its request waits."""
    both = requests.withColumnRenamed("run_timestamp_utc", "_requested").join(
        results.drop("run_timestamp_utc"), "job_id", "left")
    return both.select(
        "job_id", F.coalesce("store_id", "path_merchant_id").alias("merchant_id"),
        F.coalesce(local_date("result_period_start", tz), "path_date").alias("report_date"),
        F.coalesce("created_at", "_requested").alias("enqueue_at"), "enqueue_status", "result_status",
        "result_period_start", "result_period_end", "gross_sales_amount", "gross_sales_currency",
        "net_payout_amount", "net_payout_currency")


def _utc(df: DataFrame, path: str) -> Column:
    kind = df.select(path).schema[0].dataType
    return utc_ntz(path) if isinstance(kind, T.TimestampType) else F.col(path)


def project_reports(joined: DataFrame, tz: str | Column = "UTC") -> DataFrame:
    """Typed report rows from joined documents.

    A job without a result falls back to the landing path of its request for merchant and date,
    and a request without `created_at` to its run time, so an unfinished job has no NULL keys.
    """
    period_start, period_end = _utc(joined, "r_result.period_start"), _utc(joined, "r_result.period_end")
    return joined.select(
        F.col("jobId").alias("job_id"),
        F.coalesce("r_result.store_id", "path_merchant_id").alias("merchant_id"),
        F.coalesce(local_date(period_start, tz), "path_date").alias("report_date"),
        F.coalesce(_utc(joined, "created_at"), "run_timestamp_utc").alias("enqueue_at"),
        F.col("status").alias("enqueue_status"),
        F.col("r_status").alias("result_status"),
        period_start.alias("result_period_start"),
        period_end.alias("result_period_end"),
        F.col("r_result.totals.gross_sales.amount").cast("bigint").alias("gross_sales_amount"),
        tidy_currency("r_result.totals.gross_sales.currency").alias("gross_sales_currency"),
        F.col("r_result.totals.net_payout.amount").cast("bigint").alias("net_payout_amount"),
        tidy_currency("r_result.totals.net_payout.currency").alias("net_payout_currency"),
    )


def silver_reports(enqueue: DataFrame, result: DataFrame, tz: str | Column = "UTC") -> DataFrame:
    return project_reports(join_reports(enqueue.where(F.col("jobId").isNotNull()), result), tz)
