"""Known outcomes of the sample documents, from files to the sales fact."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import samples
from samples import records
from tablemargin.functions.pii import fill_missing_salts
from tablemargin.operators import flatten, reports, serving, star
from tablemargin.schemas import BRONZE_ORDERS
from tablemargin.sources.bronze import bronze_rejects, incomplete_pages, read_bronze, strip_provenance
from tablemargin.sources.cogs import cogs_in_minor_units, read_cogs_seed


@pytest.fixture()
def root(tmp_path):
    samples.write_file(tmp_path, "orders", samples.ORDERS_PAGE)
    samples.write_file(tmp_path, "reports_enqueue", samples.ENQUEUE)
    samples.write_file(tmp_path, "reports_result", samples.RESULT)
    return tmp_path


@pytest.fixture()
def cogs(spark, tmp_path):
    (tmp_path / "cogs.csv").write_text(samples.COGS_CSV)
    return read_cogs_seed(spark, str(tmp_path / "cogs.csv"))


def test_files_to_lines(spark, root):
    lines = flatten.silver_orders(read_bronze(spark, str(root), "orders", "files"), "salt")
    rows = records(lines, "order_id")
    assert len(rows) == 2
    assert rows[0]["order_id"] == "ord_001" and rows[0]["line_item_no"] == 1
    assert rows[0]["target_date"] == dt.date(2026, 6, 10)
    assert rows[0]["created_at"] == dt.datetime(2026, 6, 10, 12)
    assert rows[0]["run_timestamp_utc"] == dt.datetime(2026, 6, 10, 12)
    assert (rows[1]["line_item_qty"], rows[1]["line_item_unit_price"]) == (2, 400)
    assert all(len(r["customer_name_hash_salted"]) == 64 for r in rows)
    assert len({r["customer_name_hash_salted"] for r in rows}) == 2


def test_margins(spark, root, cogs):
    lines = flatten.silver_orders(read_bronze(spark, str(root), "orders", "files"), "salt", staged=False)
    got = {(r["order_id"], r["line_item_sku"], r["gross_order_value"], r["estimated_marketplace_commission"],
            r["calculated_recipe_cogs"], r["packaging_cost"], r["true_net_payout_margin"])
           for r in records(star.fact_financial_sales(lines, cogs))}
    assert got == {("ord_001", "BURGER_CLASSIC", 2500, 375, 800, 100, 1225),
                   ("ord_002", "FRIES_MEDIUM", 1800, 270, 300, 50, 1180)}
    assert star.dim_menu_catalog(lines).count() == 2


def test_report(spark, root):
    enqueue, result = (read_bronze(spark, str(root), e, "files") for e in ("reports_enqueue", "reports_result"))
    (row,) = records(reports.silver_reports(enqueue, result))
    assert (row["job_id"], row["merchant_id"], row["report_date"]) == ("job_abc123", "store_001", dt.date(2026, 6, 9))
    assert (row["gross_sales_amount"], row["net_payout_amount"], row["result_status"]) == (12500, 8750, "READY")
    # No created_at in the request: the run time stands in.
    assert row["enqueue_at"] == dt.datetime(2026, 6, 10, 12)


def test_pending_report_has_no_null_keys(spark, root):
    samples.write_file(root, "reports_enqueue", {"jobId": "job_open", "status": "QUEUED"}, run="20260611T020000Z")
    enqueue, result = (read_bronze(spark, str(root), e, "files") for e in ("reports_enqueue", "reports_result"))
    row = {r["job_id"]: r for r in records(reports.silver_reports(enqueue, result))}["job_open"]
    assert (row["merchant_id"], row["report_date"]) == ("store_001", dt.date(2026, 6, 10))
    assert row["result_status"] is None


def test_landing_again_adds_no_report_rows(spark, root):
    samples.write_file(root, "reports_enqueue", samples.ENQUEUE, run="20260611T120000Z")
    samples.write_file(root, "reports_result", samples.RESULT, run="20260611T120000Z")
    enqueue, result = (read_bronze(spark, str(root), e, "files") for e in ("reports_enqueue", "reports_result"))
    assert reports.silver_reports(enqueue, result).count() == 1


def test_source_is_a_table(spark, root):
    read_bronze(spark, str(root), "orders", "files").write.mode("overwrite").saveAsTable("bronze_orders_t")
    assert flatten.flatten_orders(read_bronze(spark, "bronze_orders_t", "orders", "table")).count() == 2


def test_unknown_endpoint_and_layout(spark, root):
    with pytest.raises(ValueError):
        read_bronze(spark, str(root), "refunds")
    with pytest.raises(ValueError):
        read_bronze(spark, str(root), "orders", "zip")


def test_numeric_merchant_ids_stay_text(spark, tmp_path):
    samples.write_file(tmp_path, "orders", samples.ORDERS_PAGE, merchant="007")
    (row,) = records(read_bronze(spark, str(tmp_path), "orders", "files").select("path_merchant_id").distinct())
    assert row["path_merchant_id"] == "007"


def test_broken_document_is_a_reject(spark, root):
    samples.write_file(root, "orders", '{"orders": [', run="20260612T000000Z")
    bronze = read_bronze(spark, str(root), "orders", "files")
    assert bronze_rejects(bronze.cache()).count() == 1
    assert flatten.flatten_orders(bronze).count() == 2


def test_incomplete_page(spark, root):
    samples.write_file(root, "orders", {"orders": [], "next_cursor": "abc"}, run="20260612T000000Z")
    assert incomplete_pages(read_bronze(spark, str(root), "orders", "files")).count() == 1


def test_strip_provenance(spark):
    df = spark.createDataFrame([("s", "1", "e", 5)], "source string, version string, endpoint string, x int")
    assert strip_provenance(df).columns == ["x"]


def test_cogs_seed(cogs):
    assert cogs.count() == 6
    assert dict(cogs.dtypes)["recipe_cost"] == "bigint"


def test_ledger_in_minor_units(spark):
    ledger = spark.sql("select 'm' merchant_id, 'S' line_item_sku, cast(3.5 as decimal(10,4)) recipe_cost, "
                       "cast(0.805 as decimal(10,4)) packaging_cost")
    (row,) = records(cogs_in_minor_units(ledger))
    assert (row["recipe_cost"], row["packaging_cost"]) == (350, 81)


ODD_ORDERS = [
    samples.order("a", [("X", 1, 100), ("Y", 2, 50), ("X", 1, 100)], total=300),
    samples.order("b", []),
    samples.order("c", None),
    samples.order("d", [("Z", 1, 0)], total=0, name=None),
]


def test_odd_orders(spark):
    lines = flatten.silver_orders(samples.bronze(spark, [samples.landing_row(ODD_ORDERS)]), "s", staged=False)
    rows = records(lines, "order_id", "line_item_no")
    assert [(r["order_id"], r["line_item_no"], r["line_item_sku"]) for r in rows] == [
        ("a", 1, "X"), ("a", 2, "Y"), ("a", 3, "X"), ("d", 1, "Z")]
    assert rows[3]["customer_name_hash_salted"] is None
    assert records(flatten.order_headers(lines).select("order_id"), "order_id") == [
        {"order_id": "a"}, {"order_id": "d"}]


def test_latest_run_keeps_all_its_lines(spark):
    early = samples.landing_row([samples.order("a", [("X", 1, 1)], total=1)])
    late = samples.landing_row([samples.order("a", [("X", 1, 1), ("Y", 1, 1)], total=2)],
                               run=samples.RUN + dt.timedelta(days=1))
    rows = records(flatten.silver_orders(samples.bronze(spark, [early, late]), "s"), "line_item_no")
    assert [(r["line_item_sku"], r["total_amount"]) for r in rows] == [("X", 2), ("Y", 2)]


def test_store_date_east_and_west_of_utc(spark):
    page = [samples.order("a", [("X", 1, 1)], at="2026-06-10T22:30:00Z")]
    bronze = samples.bronze(spark, [samples.landing_row(page)])
    for tz, day in (("Asia/Tokyo", 11), ("America/Bogota", 10), ("UTC", 10)):
        (row,) = records(flatten.silver_orders(bronze, "s", tz, staged=False))
        assert row["target_date"] == dt.date(2026, 6, day)


def test_results_do_not_depend_on_the_session_zone(spark):
    bronze = samples.bronze(spark, [samples.landing_row([samples.order("a", [("X", 1, 1)])])])
    kept = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        (row,) = records(flatten.flatten_orders(bronze).select(F.col("created_at").cast("string").alias("c")))
        assert row["c"] == "2026-06-10 12:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_served_figures(spark):
    fact = spark.createDataFrame(samples.SERVED_FACT, samples.SERVED_SCHEMA)
    mine = serving.tenant(fact, merchant_id="store_001")
    (kpi,) = records(serving.kpis(mine))
    assert (kpi["gross_total"], kpi["margin_total"], kpi["commission_total"]) == (92, 54, 19)
    assert (kpi["net_margin_pct"], kpi["commission_pct"], kpi["variance_count"]) == (58.7, 20.7, 2)
    leakage = {r["source_marketplace"]: (r["gross_sales"], r["net_payout"], r["true_profit"])
               for r in records(serving.profit_leakage(mine))}
    assert leakage == {"UberEats": (47, 37, 27), "DoorDash": (45, 36, 27)}
    assert [(r["line_item_sku"], r["net_profit"]) for r in serving.menu_engineering(mine).collect()] == [
        ("BURGER", 33), ("FRIES", 16), ("COLA", 5)]
    assert {r["order_id"] for r in records(serving.variance_log(mine))} == {"ORD-002", "ORD-004"}
    assert {r["variance_reason"] for r in records(serving.list_fact_financial_sales(fact, merchant_id="store_001"))} \
        == {"", "Fee mismatch", "Commission overcharge"}


def test_salts(spark):
    salts = spark.createDataFrame([("a", "0" * 32), ("b", None), ("c", None)], "merchant_id string, pii_salt string")
    filled = {r.merchant_id: r.pii_salt for r in fill_missing_salts(salts).collect()}
    assert filled["a"] == "0" * 32 and len({filled["b"], filled["c"]}) == 2
    assert all(len(s) == 32 and "-" not in s for s in filled.values())


def test_schema_of_documents_is_explicit():
    assert BRONZE_ORDERS.fieldNames() == ["orders", "next_cursor"]
