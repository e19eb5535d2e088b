import datetime as dt

from tablemargin.operators import runlog
from tablemargin.schemas import RUN_EVENTS

T0 = dt.datetime(2026, 6, 10, 2)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def events(spark, rows):
    return spark.createDataFrame(
        [(r, "m", "bronze_ingestion", status, at(minute), *(more or (None, None)))
         for r, status, minute, more in rows], RUN_EVENTS)


def test_run_state(spark):
    df = events(spark, [
        ("ok", "STARTED", 0, None), ("ok", "SUCCESS", 5, None),
        ("bad", "STARTED", 1, None), ("bad", "FAILED", 6, ("ValueError", "boom")),
        ("open", "STARTED", 2, None),
        ("orphan", "SUCCESS", 3, None),
        ("tie", "STARTED", 0, None), ("tie", "SUCCESS", 4, None), ("tie", "FAILED", 4, ("E", "x"))])
    rows = {r.run_id: r for r in runlog.run_state(df).collect()}
    assert {k: r.status for k, r in rows.items()} == {
        "ok": "SUCCESS", "bad": "FAILED", "open": "STARTED", "orphan": "SUCCESS", "tie": "FAILED"}
    assert rows["bad"].error_message == "boom" and rows["bad"].finished_at == at(6)
    assert [k for k, r in rows.items() if r.is_orphan] == ["orphan"]
    assert [r.run_id for r in runlog.run_history(runlog.run_state(df).where("not is_orphan")).collect()] == [
        "ok", "tie", "bad", "open"]
    assert runlog.run_history(runlog.run_state(df).where("not is_orphan"), "m").first().run_id == "open"


def test_one_failed_day_fails_the_backfill(spark):
    runs = spark.createDataFrame([("b1", "SUCCESS"), ("b1", "FAILED"), ("b1", "SUCCESS"), ("b2", "SUCCESS")],
                                 "batch string, status string")
    rows = {r.batch: (r.days_run, r.days_failed, r.exit_code) for r in runlog.backfill_summary(runs, ["batch"]).collect()}
    assert rows == {"b1": (3, 1, 1), "b2": (1, 0, 0)}


def test_report_jobs(spark):
    polls = [("ready", "PENDING", 0), ("ready", "READY", 1), ("ready", "FAILED", 2),
             ("failed", "FAILED", 0), ("cancelled", "CANCELLED", 3), ("pending", "PENDING", 0)]
    polls += [("tired", "PENDING", i) for i in range(10)]
    df = spark.createDataFrame([(j, s, at(m)) for j, s, m in polls], "job_id string, status string, polled_at timestamp_ntz")
    assert {r.job_id: r.job_state for r in runlog.report_job_state(df).collect()} == {
        "ready": "READY", "failed": "FAILED", "cancelled": "CANCELLED", "pending": "PENDING", "tired": "EXHAUSTED"}


def test_tiers_and_alerts(spark):
    rows = [("a", "FAILED", "Tier1AuthError", None), ("b", "FAILED", "Tier2LatencyError", None),
            ("c", "FAILED", "KeyError", None), ("d", "FAILED", None, 401), ("e", "FAILED", "X", 429),
            ("f", "FAILED", "X", 503), ("g", "FAILED", "X", 404), ("h", "SUCCESS", None, None)]
    log = spark.createDataFrame(
        [(r, s, c, h, "m" * 2000, "t" * 9000, at(0)) for r, s, c, h in rows],
        "run_id string, status string, error_class string, http_status int, error_message string, "
        "stack_trace string, finished_at timestamp_ntz")
    assert {r.run_id: r.error_tier for r in runlog.error_tiers(log).collect()} == {
        "a": "tier1", "b": "tier2", "c": "tier3", "d": "tier1", "e": "tier2", "f": "tier2", "g": "tier3"}
    made = runlog.alerts(log).collect()
    assert len(made) == 7 and len({r.id for r in made}) == 7
    assert {(len(r.error_message), len(r.stack_trace), r.severity, r.source) for r in made} == {
        (1000, 5000, "error", "bronze_ingestion")}
    assert runlog.alerts(log, tiers=["tier3"]).count() == 2


def test_freshness(spark):
    stores = spark.createDataFrame([(m, "America/New_York") for m in ("fresh", "late", "none")]
                                   + [("early", "America/Los_Angeles")], "merchant_id string, store_tz string")
    runs = spark.createDataFrame(
        [("fresh", "SUCCESS", dt.datetime(2026, 6, 10, 9)), ("late", "SUCCESS", dt.datetime(2026, 6, 10, 11)),
         ("none", "FAILED", dt.datetime(2026, 6, 10, 9)), ("none", "SUCCESS", dt.datetime(2026, 6, 9, 9)),
         ("early", "SUCCESS", dt.datetime(2026, 6, 9, 10))],
        "merchant_id string, status string, finished_at timestamp_ntz")
    now = dt.datetime(2026, 6, 10, 12)
    assert {r.merchant_id: r.freshness for r in runlog.freshness(runs, stores, now).collect()} == {
        "fresh": "FRESH", "late": "LATE", "none": "MISSED", "early": "PENDING"}
