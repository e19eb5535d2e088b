"""Run log, report jobs, error tiers, alerts and freshness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablemargin.operators import runlog
from tablemargin.plans.registry import query

_NOW = dt.datetime(2024, 1, 15, 9, 30, 0)


@query("SELECT * FROM runs", ("runs",))
def run_state(t):
    return runlog.run_state(t.run_events())


@query("SELECT run_id, merchant_id, status, started_at, finished_at FROM runlog", ("runlog",))
def run_history(t):
    return runlog.run_history(t.run_log()).select("run_id", "merchant_id", "status", "started_at", "finished_at")


@query("SELECT run_id, status, started_at FROM runlog WHERE merchant_id = 'cust_7'", ("runlog",))
def run_history_of_merchant(t):
    return runlog.run_history(t.run_log(), "cust_7").select("run_id", "status", "started_at")


@query("""SELECT merchant_id, started_at, run_id, status FROM runlog
          QUALIFY row_number() OVER (PARTITION BY merchant_id ORDER BY started_at DESC, run_id DESC) = 1""", ("runlog",))
def latest_run(t):
    return runlog.latest_run(t.run_log())


@query("""SELECT merchant_id, CAST(started_at AS DATE) AS batch_date, count(*) AS days_run,
                 count_if(status = 'FAILED') AS days_failed, count_if(status = 'SUCCESS') AS days_succeeded,
                 CAST(max(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS INTEGER) AS exit_code
          FROM runlog GROUP BY 1, 2""", ("runlog",))
def backfill_summary(t):
    runs = t.run_log().withColumn("batch_date", F.col("started_at").cast("date"))
    return runlog.backfill_summary(runs, ["merchant_id", "batch_date"])


@query("""SELECT job_id, n AS poll_count, last_polled_at,
                 coalesce(f.status, CASE WHEN n >= 10 THEN 'EXHAUSTED' ELSE 'PENDING' END) AS job_state
          FROM (SELECT job_id, count(*) AS n, max(polled_at) AS last_polled_at FROM polls GROUP BY 1)
          LEFT JOIN (SELECT job_id, status FROM polls WHERE status <> 'PENDING'
                     QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY polled_at, status) = 1) f USING (job_id)""",
       ("polls",))
def report_job_state(t):
    return runlog.report_job_state(t.polls())


_TIER = """CASE WHEN error_class = 'Tier1AuthError' THEN 'tier1' WHEN error_class = 'Tier2LatencyError' THEN 'tier2'
    WHEN http_status IN (401, 403) THEN 'tier1' WHEN http_status = 429 OR http_status BETWEEN 500 AND 599 THEN 'tier2'
    ELSE 'tier3' END"""


@query(f"""SELECT run_id, error_class, {_TIER} AS error_tier FROM runlog WHERE status = 'FAILED'""", ("runlog",))
def error_tiers(t):
    return runlog.error_tiers(t.run_log()).select("run_id", "error_class", "error_tier")


_ALERT = """SELECT sha256('bronze_ingestion|' || run_id || '|' || CAST(finished_at AS VARCHAR)) AS id,
                 'bronze_ingestion' AS source, 'error' AS severity, error_class,
                 left(error_message, 1000) AS error_message, left(stack_trace, 5000) AS stack_trace,
                 finished_at AS created_at
          FROM runlog WHERE status = 'FAILED'"""


@query(_ALERT, ("runlog",))
def alerts(t):
    return runlog.alerts(t.run_log())


@query(_ALERT + f" AND {_TIER} = 'tier3'", ("runlog",))
def alerts_of_tier3(t):
    return runlog.alerts(t.run_log(), tiers=["tier3"])


_LOCAL = "(finished_at AT TIME ZONE 'UTC' AT TIME ZONE store_tz)"
_LOCAL_NOW = f"(TIMESTAMP '{_NOW}' AT TIME ZONE 'UTC' AT TIME ZONE store_tz)"


@query(f"""SELECT merchant_id, store_tz, last_success_at,
                  CASE WHEN first_today <= due THEN 'FRESH' WHEN first_today IS NOT NULL THEN 'LATE'
                       WHEN {_LOCAL_NOW} <= due THEN 'PENDING' ELSE 'MISSED' END AS freshness
           FROM (SELECT s.merchant_id, s.store_tz, max(finished_at) AS last_success_at,
                        min({_LOCAL}) FILTER (CAST({_LOCAL} AS DATE) = CAST({_LOCAL_NOW} AS DATE)) AS first_today,
                        CAST(CAST({_LOCAL_NOW} AS DATE) AS TIMESTAMP) + INTERVAL 6 HOUR AS due
                 FROM stores s LEFT JOIN (SELECT * FROM runlog WHERE status = 'SUCCESS'
                        AND finished_at <= TIMESTAMP '{_NOW}') r ON r.merchant_id = s.merchant_id
                 GROUP BY s.merchant_id, s.store_tz)""", ("stores", "runlog"))
def freshness(t):
    return runlog.freshness(t.run_log(), t.stores(), _NOW)
