import datetime as dt

import pytest
from pyspark.sql import functions as F

import samples
from tablemargin.operators import quality
from tablemargin.operators.flatten import silver_orders
from tablemargin.sources.bronze import validate_landing
from tablemargin.sources.tables import exists


def lines(spark, orders, **kw):
    return silver_orders(samples.bronze(spark, [samples.landing_row(orders, **kw)]), "s", staged=False)


def failed(results):
    return {r.check_name: r.failing_rows for r in results.collect() if r.failing_rows}


GOOD = [samples.order("a", [("X", 1, 100), ("Y", 2, 50)]), samples.order("b", [("X", 1, 100)], channel="doordash")]


def test_orders_with_several_items_pass(spark):
    results = quality.check_silver_orders(lines(spark, GOOD))
    assert failed(results) == {}
    assert quality.gate(results).first().publish


def test_each_fault_is_found(spark):
    bad = [samples.order("q", [("X", 0, 1)]), samples.order("neg", [("X", 1, 1)], total=-1),
           samples.order("zero", [("X", 1, 1)], total=0), samples.order("null", [("X", 1, 1)], total=None),
           samples.order("cur", [("X", 1, 1)], currency="us"), samples.order("pii", [("X", 1, 1)], phone=None),
           samples.order(None, [("X", 1, 1)])]
    results = quality.check_silver_orders(lines(spark, bad))
    assert failed(results) == {
        "line_item_qty_positive": 1, "total_amount_non_negative": 1, "total_amount_not_zero": 1,
        "not_null_total_amount": 1, "currency_three_letters": 1, "not_null_customer_phone_hash_salted": 1,
        "not_null_order_id": 1}
    verdict = quality.gate(results).first()
    assert (verdict.failed_errors, verdict.failed_warnings, verdict.publish) == (5, 2, False)
    with pytest.raises(quality.QualityError, match="line_item_qty_positive: 1"):
        quality.enforce(results)


def test_duplicate_orders(spark):
    twice = lines(spark, [*GOOD, samples.order("a", [("Z", 1, 1)])])
    assert failed(quality.check_silver_orders(twice)) == {
        "unique_order_id_source_marketplace": 1, "unique_order_id_source_marketplace_line_item_no": 1}
    rows = quality.duplicate_rows(twice, ["order_id", "source_marketplace"]).collect()
    assert [r.order_id for r in rows] == ["a"] * 3


def test_warnings_do_not_block_but_errors_do(spark, tmp_path):
    path = str(tmp_path / "published")
    warned = lines(spark, [samples.order("zero", [("X", 1, 1)], total=0)])
    quality.publish(warned, quality.check_silver_orders(warned), path)
    assert spark.read.parquet(path).count() == 1
    broken = lines(spark, [samples.order("neg", [("X", 1, 1)], total=-1)])
    with pytest.raises(quality.QualityError):
        quality.publish(broken, quality.check_silver_orders(broken), path)
    assert spark.read.parquet(path).first().order_id == "zero" and exists(spark, path)


def test_warn_status_severity_is_a_choice(spark):
    from tablemargin.schemas import SILVER_REPORTS

    t = dt.datetime(2026, 6, 10)
    df = spark.createDataFrame([("j", "m", t.date(), t, "QUEUED", "WARN", t, t, 1, "USD", 1, "USD")], SILVER_REPORTS)
    assert quality.gate(quality.check_silver_reports(df)).first().publish
    assert not quality.gate(quality.check_silver_reports(df, "error")).first().publish


def test_path_and_payload_tenant(spark):
    bronze = samples.bronze(spark, [samples.landing_row(GOOD, merchant="merchant_001")])
    from tablemargin.operators.flatten import flatten_orders

    result = quality.run_checks(flatten_orders(bronze), "bronze_orders", [quality.tenant_isolation()])
    assert failed(result) == {"path_merchant_is_payload_merchant": 2}


def test_quarantine(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", None, 2), ("c", 3, 4)], "id string, gross bigint, net bigint")
    filled, anomalies = quality.quarantine_nulls(df, ["gross", "net"])
    assert {tuple(r) for r in filled.collect()} == {("a", 1, 0, True), ("b", 0, 2, True), ("c", 3, 4, False)}
    assert {r.id for r in anomalies.collect()} == {"a", "b"}


def test_hashes_are_stable_between_builds(spark):
    first, second = lines(spark, GOOD), lines(spark, GOOD)
    keys, hashes = ["order_id", "line_item_no"], ["customer_name_hash_salted", "customer_phone_hash_salted"]
    assert quality.hash_stable(first, second, keys, hashes).count() == 0
    resalted = silver_orders(samples.bronze(spark, [samples.landing_row(GOOD)]), "other", staged=False)
    assert quality.hash_stable(first, resalted, keys, hashes).count() == 3


def test_landing_rows(spark):
    today = dt.date(2026, 6, 10)
    rows = [("ok-1_A", "orders", today), ("a" * 64, "reports_result", today + dt.timedelta(days=1)),
            ("a" * 65, "orders", today), ("", "orders", today), ("x@y", "orders", today), (None, "orders", today),
            ("m", "refunds", today), ("m", None, today), ("m", "orders", None),
            ("m", "orders", today + dt.timedelta(days=2))]
    df = spark.createDataFrame(rows, "merchant_id string, endpoint string, target_date date")
    accepted, rejects = validate_landing(df, today)
    assert [r.far_future for r in accepted.collect()] == [False, False, True]
    assert rejects.groupBy("reject_reason").count().orderBy("reject_reason").collect() == [
        ("BAD_ENDPOINT", 2), ("BAD_MERCHANT_ID", 4), ("BAD_TARGET_DATE", 1)]


def test_all_row_checks_share_one_scan(spark):
    df = spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b"))
    plan = quality.run_checks(df, "t", quality.not_null(["a", "b"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range") == 1
