"""Report jobs whose requests and results land apart, in any order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablemargin.operators import quality
from tablemargin.plans.build import Warehouse, build
from tablemargin.plans.registry import query
from tablemargin.plans.shared_tables import SALT, landing_date
from tablemargin.session import scratch_path
from tablemargin.sources.bronze import DAILY, read_bronze, write_bronze
from tablemargin.streaming.ingest import stream_bronze
from tablemargin.streaming.reports import stream_reports


@query("SELECT * FROM rep", ("rep",))
def late_results_build(t):
    """Five builds that each see a window of the documents: results before requests, after them, and requests again."""
    wh = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), SALT)
    requests, results = t.bronze_enqueue(), t.bronze_result()
    third = F.dayofmonth("path_date") % 3 == 0
    first = requests.where("status = 'QUEUED'")
    for window in ({"result": results.where(third)}, {"enqueue": first}, {"result": results.where(~third)},
                   {"enqueue": requests.where("status <> 'QUEUED'")}, {"enqueue": first}):
        build(wh, select=["silver_reports"], **window)
    return wh.read("silver_reports")


def _landed(t, root: str, documents: DataFrame, endpoint: str, payload, cut: int) -> None:
    """Documents as JSON, those of days divisible by `cut` broken off half way.

    Every job has a run of its own, so a directory for each run of a merchant would hold one document.
    """
    whole = F.to_json(payload)
    half = F.expr("left(whole, length(whole) div 2)")
    write_bronze(documents.withColumn("whole", whole).select(
        F.col("path_merchant_id").alias("merchant_id"), F.lit(endpoint).alias("endpoint"), landing_date(F.col("path_date")).alias("target_date"),
        "run_timestamp_utc", F.when(F.dayofmonth("path_date") % cut == 0, half).otherwise(F.col("whole")).alias("payload")), root, DAILY)


@query("""SELECT 'bronze_reports_enqueue' AS table_name, 'job_id_present' AS check_name, 'warn' AS severity,
                 CAST(coalesce(sum(CASE WHEN d = 2 THEN 1 ELSE 0 END), 0) AS BIGINT) AS failing_rows FROM jobs
          UNION ALL SELECT 'bronze_reports_enqueue', 'document_parsed', 'error',
                 CAST(coalesce(sum(CASE WHEN extract(day FROM day) % 7 <> 0 THEN 0 WHEN d % 4 = 0 THEN 2 ELSE 1 END), 0) AS BIGINT) FROM jobs
          UNION ALL SELECT 'bronze_reports_result', 'job_id_present', 'warn', 0
          UNION ALL SELECT 'bronze_reports_result', 'document_parsed', 'error',
                 count_if(extract(day FROM day) % 9 = 0 AND d % 10 <> 1) FROM jobs""", ("jobs",))
def report_gate(t):
    """Requests and results, some broken off, some without a job: the checks that stop a build before it keeps anything."""
    t.keep_report_jobs()
    root = scratch_path(t.spark, "report-landing")
    job = F.when(F.dayofmonth("path_date") != 2, F.col("jobId")).alias("jobId")
    _landed(t, root, t.bronze_enqueue(), "reports_enqueue", F.struct(job, "status"), 7)
    _landed(t, root, t.bronze_result(), "reports_result", F.struct("jobId", "status"), 9)
    return quality.check_landing(read_bronze(t.spark, root, "reports_enqueue"), "reports_enqueue").unionByName(
        quality.check_landing(read_bronze(t.spark, root, "reports_result"), "reports_result"))


@query("SELECT * FROM rep", ("rep",))
def streamed_report_join(t):
    """Requests land and are streamed, then their results, three hours later; then documents of the next year close the window."""
    t.keep_report_jobs()
    root, checkpoint = scratch_path(t.spark, "report-stream"), scratch_path(t.spark, "report-stream-log")
    wh = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), SALT)

    def land(documents: DataFrame, endpoint: str, *columns: str) -> None:
        write_bronze(documents.select(
            F.col("path_merchant_id").alias("merchant_id"), F.lit(endpoint).alias("endpoint"), F.col("path_date").alias("target_date"),
            "run_timestamp_utc", F.to_json(F.struct(*columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"}).alias("payload")),
            root, ["endpoint"])

    def run() -> None:
        stream_reports(wh, stream_bronze(t.spark, root, "reports_enqueue"), stream_bronze(t.spark, root, "reports_result"),
                       checkpoint).awaitTermination()

    requests = t.bronze_enqueue()
    end = requests.agg(F.max("path_date")).first()[0]
    land(requests, "reports_enqueue", "jobId", "status", "created_at")
    run()
    land(t.bronze_result().withColumn("run_timestamp_utc", F.timestamp_add("HOUR", F.lit(3), "run_timestamp_utc")),
         "reports_result", "jobId", "status", "result")
    run()
    marker = requests.limit(1).select(
        F.lit("store_000").alias("path_merchant_id"), F.lit(end).alias("path_date"), F.lit("job_end").alias("jobId"), F.lit("END").alias("status"),
        F.timestamp_add("DAY", F.lit(400), F.lit(end).cast("timestamp_ntz")).alias("run_timestamp_utc"))
    land(marker, "reports_enqueue", "jobId", "status")
    land(marker, "reports_result", "jobId", "status")
    run()
    return wh.read("silver_reports").where("job_id <> 'job_end'")
