"""Report requests joined with their results as both are streamed."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tablemargin.operators.reports import flat_requests, flat_results
from tablemargin.plans.build import Warehouse, take_up_reports
from tablemargin.schemas import REPORT_REQUESTS, REPORT_RESULTS
from tablemargin.sources.bronze import CORRUPT


def _parsed(documents: DataFrame, endpoint: str) -> DataFrame:
    """Stop at a document that does not parse: it has no job, so that it would be left out unseen."""
    if CORRUPT not in documents.columns:
        return documents
    message = F.concat(F.lit(f"{endpoint}: a document does not parse: "), F.left(CORRUPT, F.lit(200)))
    return documents.withColumn("jobId", F.when(F.col(CORRUPT).isNotNull(), F.raise_error(message)).otherwise(F.col("jobId")))


def join_report_streams(requests: DataFrame, results: DataFrame, late: str = "12 hours", within: str = "3 days") -> DataFrame:
    """Requests and results of the same job whose run times are at most `within` apart, as `request` and `result`.

    A pair comes out as soon as its second document is there.  A request or result without the other comes out alone
    when the watermarks have passed its time by `within`, and leaves the state with that; `late` is how far documents
    may lie behind the newest of their kind.  So the state holds the documents of `late` and `within` only.  Documents
    that come later than `late` are dropped by the engine and counted in the query's progress (`dropped_rows`);
    the next `build` over the landing files takes them up, as its ledger does not have them.
    """
    sides = []
    for name, rows, schema in (("request", flat_requests(_parsed(requests, "reports_enqueue")), REPORT_REQUESTS),
                               ("result", flat_results(_parsed(results, "reports_result")), REPORT_RESULTS)):
        at = f"{name}_at"
        sides.append(rows.select(F.col("job_id").alias(f"{name}_job"), F.col("run_timestamp_utc").cast("timestamp").alias(at),
                                 F.struct(*schema.names).alias(name)).withWatermark(at, late))
    near = F.expr(f"result_at >= request_at - interval {within} AND result_at <= request_at + interval {within}")
    return sides[0].join(sides[1], (F.col("request_job") == F.col("result_job")) & near, "full_outer").select("request", "result")


def stream_reports(wh: Warehouse, requests: DataFrame, results: DataFrame, checkpoint: str, stores: DataFrame | None = None,
                   late: str = "12 hours", within: str = "3 days") -> StreamingQuery:
    """Join what has landed so far and merge it into `silver_reports`, then stop.

    What comes out of the join is taken up half by half (`take_up_reports`): a pair that is replayed after a failure
    changes nothing, a job's later request or result replaces the earlier one, and a result that came out alone waits
    in the table of results, so that one further than `within` from its request still finds it there.
    """
    def take_up(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            take_up_reports(replace(wh, spark=batch.sparkSession), {
                "reports_enqueue": batch.where("request is not null").select("request.*"),
                "reports_result": batch.where("result is not null").select("result.*")}, stores)
        finally:
            batch.unpersist()

    joined = join_report_streams(requests, results, late, within)
    return (joined.writeStream.foreachBatch(take_up).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def dropped_rows(query: StreamingQuery) -> int:
    """Documents that came later than `late` in the batches whose progress is still kept."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
