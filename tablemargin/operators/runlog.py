"""Run log, report jobs and alerts, folded from append-only event tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tablemargin.functions.times import local_time

# Statuses, error classes per tier, text limits, poll limit, hour of the freshness promise.
TERMINAL_RUN = ("SUCCESS", "FAILED")
TERMINAL_JOB = ("READY", "FAILED", "CANCELLED")
AUTH_ERRORS = ("Tier1AuthError",)
LATENCY_ERRORS = ("Tier2LatencyError",)
MESSAGE_LIMIT, STACK_LIMIT = 1000, 5000
MAX_POLLS = 10
FRESH_BY_HOUR = 6


def run_state(events: DataFrame) -> DataFrame:
    """Fold STARTED and terminal events into one row per run.

    A run without a terminal event stays STARTED; a terminal event without a start is flagged
    `is_orphan`.  With several terminal events the latest counts, ties to FAILED.
    """
    started = F.col("status") == "STARTED"
    ended = F.col("status").isin(*TERMINAL_RUN)
    last = F.max(F.when(ended, F.struct(
        F.col("event_at"), (F.col("status") == "FAILED").alias("failed"), F.col("status"),
        F.col("error_class"), F.col("error_message"))))
    folded = events.groupBy("run_id").agg(
        F.min("merchant_id").alias("merchant_id"),
        F.min("pipeline_name").alias("pipeline_name"),
        F.min(F.when(started, F.col("event_at"))).alias("started_at"),
        last.alias("_last"))
    return folded.select(
        F.col("run_id").alias("id"), "merchant_id", "run_id", "pipeline_name",
        F.coalesce(F.col("_last.status"), F.lit("STARTED")).alias("status"),
        "started_at", F.col("_last.event_at").alias("finished_at"),
        F.col("_last.error_class").alias("error_class"),
        F.col("_last.error_message").alias("error_message"),
        F.col("started_at").isNull().alias("is_orphan"))


def run_history(runs: DataFrame, merchant_id: str | None = None) -> DataFrame:
    """Runs in the order they started, or one merchant's, latest first."""
    if merchant_id is None:
        return runs.orderBy("started_at", "run_id")
    mine = runs.where(F.col("merchant_id") == merchant_id)
    return mine.orderBy(F.col("started_at").desc(), "run_id")


def latest_run(runs: DataFrame) -> DataFrame:
    """Each merchant's most recently started run."""
    best = F.max(F.struct("started_at", "run_id", "status"))
    return runs.groupBy("merchant_id").agg(best.alias("b")).select(
        "merchant_id", F.col("b.started_at").alias("started_at"),
        F.col("b.run_id").alias("run_id"), F.col("b.status").alias("status"))


def backfill_summary(runs: DataFrame, batch: list[str]) -> DataFrame:
    """Per batch: days run, failed and done; exit_code 1 as soon as one day failed."""
    failed = F.col("status") == "FAILED"
    return runs.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("days_run"),
        F.count_if(failed).alias("days_failed"),
        F.count_if(F.col("status") == "SUCCESS").alias("days_succeeded"),
        F.max(F.when(failed, 1).otherwise(0)).alias("exit_code"))


def report_job_state(polls: DataFrame, max_polls: int = MAX_POLLS) -> DataFrame:
    """Each report job's state from its poll responses (`job_id`, `status`, `polled_at`).

    The first terminal response decides, as polling stops there; without one within `max_polls`
    responses the job is EXHAUSTED, otherwise PENDING.
    """
    terminal = F.col("status").isin(*TERMINAL_JOB)
    first = F.min(F.when(terminal, F.struct("polled_at", "status")))
    jobs = polls.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("poll_count"), first.alias("f"), F.max("polled_at").alias("last_polled_at"))
    return jobs.select(
        "job_id", "poll_count", "last_polled_at",
        F.coalesce(F.col("f.status"), F.when(F.col("poll_count") >= max_polls, "EXHAUSTED"), F.lit("PENDING"))
        .alias("job_state"))


def error_tier(error_class: Column, http_status: Column | None = None) -> Column:
    """tier1 (sign-in), tier2 (marketplace slow or down) or tier3 (everything else)."""
    by_class = F.when(error_class.isin(*AUTH_ERRORS), "tier1").when(error_class.isin(*LATENCY_ERRORS), "tier2")
    if http_status is None:
        return F.coalesce(by_class, F.lit("tier3"))
    by_status = F.when(http_status.isin(401, 403), "tier1").when(
        (http_status == 429) | http_status.between(500, 599), "tier2")
    return F.coalesce(by_class, by_status, F.lit("tier3"))


def error_tiers(log: DataFrame) -> DataFrame:
    """Failed runs with their tier."""
    status = F.col("http_status") if "http_status" in log.columns else None
    return log.where(F.col("status") == "FAILED").withColumn(
        "error_tier", error_tier(F.col("error_class"), status))


def alerts(log: DataFrame, source: str = "bronze_ingestion", tiers: list[str] | None = None) -> DataFrame:
    """One engineering alert per failed run, or per failure of the given tiers."""
    failed = error_tiers(log)
    if tiers is not None:
        failed = failed.where(F.col("error_tier").isin(*tiers))
    stack = F.col("stack_trace") if "stack_trace" in log.columns else F.lit(None).cast("string")
    return failed.select(
        F.sha2(F.concat_ws("|", F.lit(source), "run_id", F.col("finished_at").cast("string")), 256).alias("id"),
        F.lit(source).alias("source"), F.lit("error").alias("severity"), "error_class",
        F.substring("error_message", 1, MESSAGE_LIMIT).alias("error_message"),
        F.substring(stack, 1, STACK_LIMIT).alias("stack_trace"),
        F.col("finished_at").alias("created_at"))


def freshness(
    runs: DataFrame, stores: DataFrame, now: Column | dt.datetime, by_hour: int = FRESH_BY_HOUR
) -> DataFrame:
    """Whether each store's data was complete by `by_hour` o'clock of its day at UTC time `now`.

    `stores` has merchant_id and store_tz.  FRESH: a run of the store's current day succeeded
    before the hour.  LATE: it succeeded after.  PENDING: the hour has not come.  MISSED: it has.
    """
    at = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    zones = stores.select("merchant_id", "store_tz")
    done = runs.where((F.col("status") == "SUCCESS") & (F.col("finished_at") <= at))
    last = done.groupBy("merchant_id").agg(F.max("finished_at").alias("last_success_at"))
    # No local day is longer than 25 hours: only these runs can be of the current one.
    recent = done.where(F.col("finished_at") >= F.timestamp_add("HOUR", F.lit(-26), at))
    today = local_time(at, F.col("store_tz")).cast("date")
    first = recent.select("merchant_id", "finished_at").join(zones, "merchant_id").select(
        "merchant_id", local_time("finished_at", F.col("store_tz")).alias("local_done"), today.alias("today")).where(
        F.col("local_done").cast("date") == F.col("today")).groupBy("merchant_id").agg(
        F.min("local_done").alias("_first"))
    joined = zones.join(last, "merchant_id", "left").join(first, "merchant_id", "left")
    deadline = F.timestamp_add("HOUR", F.lit(by_hour), today.cast("timestamp_ntz"))
    state = (F.when(F.col("_first") <= deadline, "FRESH").when(F.col("_first").isNotNull(), "LATE")
             .when(local_time(at, F.col("store_tz")) <= deadline, "PENDING").otherwise("MISSED"))
    return joined.select("merchant_id", "store_tz", "last_success_at", state.alias("freshness"))
