"""Builds: increments equal one full build, and failed gates change nothing."""

import datetime as dt

import pytest

import samples
from tablemargin.operators import flatten, quality
from tablemargin.operators.reports import silver_reports
from tablemargin.plans.build import Warehouse, build, save_costs
from tablemargin.schemas import COGS_SEED
from tablemargin.sources.bronze import read_bronze, write_bronze, write_report_pair
from tablemargin.streaming.ingest import stream_bronze, stream_bronze_files, stream_merge

DAY = dt.timedelta(days=1)


@pytest.fixture(scope="module")
def cogs(spark):
    return spark.createDataFrame([("store_001", "X", 10, 1), ("store_002", "Y", 20, 2)], COGS_SEED)


def rounds():
    """Three landing rounds: new orders, a corrected order, and a late file for an old day."""
    o = samples.order
    first = [samples.landing_row([o("a", [("X", 1, 100), ("Y", 1, 50)], total=150), o("b", [("X", 2, 100)])]),
             samples.landing_row([o("z", [("Y", 1, 9)], store="store_002")], merchant="store_002")]
    second = [samples.landing_row([o("a", [("X", 1, 90)], total=90, at="2026-06-11T12:00:00Z")],
                                  run=samples.RUN + DAY)]
    third = [samples.landing_row([o("old", [("X", 1, 5)], at="2026-05-01T12:00:00Z")], run=samples.RUN + 2 * DAY,
                                 day=dt.date(2026, 5, 1)),
             samples.landing_row([o("y", [("Y", 3, 9)], store="store_002")], run=samples.RUN + DAY,
                                 merchant="store_002")]
    return [first, second, third]


def tables(wh):
    keep = ["merchant_id", "order_id", "source_marketplace", "line_item_sku"]
    return (
        sorted(tuple(r) for r in wh.read("silver_orders").select(
            *keep, "line_item_no", "total_amount", "run_timestamp_utc").collect()),
        sorted(tuple(r) for r in wh.read("dim_menu_catalog").select(
            "merchant_id", "line_item_sku", "line_item_name", "first_seen_at", "last_seen_at").collect()),
        sorted(tuple(r) for r in wh.read("fact_financial_sales").select(
            *keep, "line_item_no", "gross_order_value", "true_net_payout_margin").collect()))


@pytest.fixture(scope="module")
def built_in_rounds(spark, cogs, tmp_path_factory):
    """Built once: none of the tests below may change its tables."""
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("rounds")), "salt")
    landed = []
    for rows in rounds():
        landed += rows
        build(wh, orders=samples.bronze(spark, landed), cogs=cogs)
    return wh


def test_increments_equal_one_build(spark, cogs, tmp_path, built_in_rounds):
    once = Warehouse(spark, str(tmp_path / "once"), "salt")
    everything = samples.bronze(spark, [r for rows in rounds() for r in rows])
    build(once, orders=everything, cogs=cogs)
    want = tables(once)
    assert tables(built_in_rounds) == want
    # The corrected order lost its second line, and its SKU Y is gone from that merchant's menu.
    assert [(r[1], r[3]) for r in want[0] if r[0] == "store_001"] == [("a", "X"), ("b", "X"), ("old", "X")]
    assert [r[:2] for r in want[1]] == [("store_001", "X"), ("store_002", "Y")]
    build(once, orders=everything, cogs=cogs, full_refresh=True)
    assert tables(once) == want


def test_building_again_changes_nothing(spark, cogs, built_in_rounds):
    before = tables(built_in_rounds)
    build(built_in_rounds, orders=samples.bronze(spark, [r for rows in rounds() for r in rows]), cogs=cogs)
    assert tables(built_in_rounds) == before


def land(spark, root, rows):
    write_bronze(samples.landing(spark, rows), root)
    return read_bronze(spark, root, "orders")


def test_nothing_is_lost_between_builds(spark, cogs, tmp_path):
    """Late, same-second, emptied and out-of-order documents and a build that stopped equal one full build."""
    o, root = samples.order, str(tmp_path / "landing")
    wh, once = (Warehouse(spark, str(tmp_path / n), "salt") for n in ("steps", "once"))
    rows = [samples.landing_row([o("new", [("X", 1, 5)], total=5), o("gone", [("X", 1, 7), ("Y", 1, 7)], total=14)], run=samples.RUN + DAY)]
    build(wh, orders=land(spark, root, rows), cogs=cogs)
    # An older run lands late, and a second file of the same second; this build stops after the lines.
    build(wh, orders=land(spark, root, [samples.landing_row([o("late", [("X", 2, 5)], total=10), o("new", [("X", 9, 9)], total=81)])]),
          select=["silver_orders"])
    build(wh, orders=land(spark, root, [samples.landing_row([o("second", [("Y", 1, 3)], total=3)], run=samples.RUN + DAY)]), cogs=cogs)
    # The latest run of an order has no items any more; then an older run of it arrives once more.
    build(wh, orders=land(spark, root, [samples.landing_row([o("gone", None, total=14)], run=samples.RUN + 2 * DAY)]), cogs=cogs)
    everything = land(spark, root, [samples.landing_row([o("gone", [("X", 1, 7)], total=7)], run=samples.RUN + DAY * 1.5)])
    build(wh, orders=everything, cogs=cogs)
    build(once, orders=read_bronze(spark, root, "orders"), cogs=cogs)
    assert tables(wh) == tables(once)
    assert sorted({r[1] for r in tables(wh)[0]}) == ["late", "new", "second"]
    assert sorted(map(str, wh.read("served_fact").collect())) == sorted(map(str, once.read("served_fact").select(wh.read("served_fact").columns).collect()))


def test_processed_files_are_not_parsed_again(spark, cogs, tmp_path):
    root = str(tmp_path / "landing")
    wh = Warehouse(spark, str(tmp_path / "w"), "salt")
    build(wh, orders=land(spark, root, rounds()[0]), cogs=cogs)
    results = build(wh, orders=read_bronze(spark, root, "orders", modified_after=wh.landing_mark()), cogs=cogs)
    assert results.where("failing_rows > 0").count() == 0
    assert wh.read("_progress/orders").count() == wh.read("_progress/orders").distinct().count() > 0


def test_unparsable_documents_stop_the_build(spark, cogs, tmp_path):
    bad = ("store_001", "orders", dt.date(2026, 6, 10), samples.RUN, '{"orders": [{"id": "x"')
    with pytest.raises(quality.QualityError, match="document_parsed"):
        build(Warehouse(spark, str(tmp_path / "w"), "salt"), orders=land(spark, str(tmp_path / "landing"), [bad]), cogs=cogs)


def test_cost_rows_of_one_item_double_no_line(spark, cogs, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "w"), "salt")
    with pytest.raises(quality.QualityError, match="unique_merchant_id_line_item_sku"):
        build(wh, orders=samples.bronze(spark, rounds()[0]), cogs=cogs.unionByName(cogs))


def test_failed_gate_leaves_the_table(spark, cogs, built_in_rounds):
    before = tables(built_in_rounds)
    bad = samples.landing_row([samples.order("bad", [("X", 0, 1)])], run=samples.RUN + 5 * DAY)
    with pytest.raises(quality.QualityError, match="line_item_qty_positive"):
        build(built_in_rounds, orders=samples.bronze(spark, [bad]), cogs=cogs)
    assert tables(built_in_rounds) == before


def test_select(spark, cogs, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "w"), "salt")
    build(wh, orders=samples.bronze(spark, rounds()[0]), select=["silver_orders"])
    results = build(wh, cogs=cogs, select=["fact_financial_sales"])
    assert {r.table_name for r in results.collect()} == {"fact_financial_sales", "merchant_cogs"}
    with pytest.raises(ValueError):
        build(wh, select=["gold"])


def landed_jobs(spark, root):
    import json

    from pyspark.sql import Row

    rows = [Row(merchant_id="store_001", target_date=dt.date(2026, 6, 9), run_timestamp_utc=samples.RUN,
                request_payload=json.dumps(samples.ENQUEUE), result_payload=json.dumps(samples.RESULT))]
    write_report_pair(spark.createDataFrame(
        rows, "merchant_id string, target_date date, run_timestamp_utc timestamp_ntz, "
              "request_payload string, result_payload string"), root)


def test_landing_keeps_payloads_and_appends(spark, tmp_path):
    root = str(tmp_path / "landing")
    rows = rounds()[0]
    write_bronze(samples.landing(spark, rows), root)
    landed_jobs(spark, root)
    assert sorted(r.payload for r in spark.read.parquet(root).where("endpoint = 'orders'").collect()) == sorted(
        r[4] for r in rows)
    write_bronze(samples.landing(spark, rounds()[1]), root)
    orders = read_bronze(spark, root, "orders")
    assert flatten.flatten_orders(orders).count() == 4
    assert flatten.silver_orders(orders, "s").select("order_id").distinct().count() == 3
    reports = silver_reports(read_bronze(spark, root, "reports_enqueue"), read_bronze(spark, root, "reports_result"))
    assert reports.first().net_payout_amount == 8750


def test_reports_model(spark, tmp_path):
    root = str(tmp_path / "landing")
    landed_jobs(spark, root)
    wh = Warehouse(spark, str(tmp_path / "w"), "salt")
    for _ in range(2):
        build(wh, enqueue=read_bronze(spark, root, "reports_enqueue"),
              result=read_bronze(spark, root, "reports_result"), select=["silver_reports"])
    assert wh.read("silver_reports").count() == 1


def test_saved_costs_change_past_margins(spark, cogs, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "w"), "salt")
    build(wh, orders=samples.bronze(spark, rounds()[0]), cogs=cogs)
    row = "timestamp_ntz'2026-06-1{d}' updated_at, cast({c} as decimal(10,4)) recipe_cost, " \
        "cast(0.5 as decimal(10,4)) packaging_cost"
    columns = ["merchant_id", "line_item_sku", "recipe_cost", "packaging_cost", "updated_at"]
    edits = [spark.sql(f"select 'store_001' merchant_id, 'X' line_item_sku, {row.format(d=d, c=c)}").select(*columns)
             for d, c in ((2, 0.3), (1, 0.2))]
    save_costs(wh, edits[0].unionByName(edits[1]))
    got = {(r.order_id, r.line_item_sku): (r.calculated_recipe_cogs, r.packaging_cost, r.true_net_payout_margin)
           for r in wh.read("fact_financial_sales").where("merchant_id = 'store_001'").collect()}
    assert got == {("a", "X"): (30, 50, 47), ("a", "Y"): (0, 0, 127), ("b", "X"): (30, 50, 770)}
    save_costs(wh, edits[1])
    assert wh.read("merchant_cogs").count() == 1
    assert wh.read("fact_financial_sales").agg({"calculated_recipe_cogs": "max"}).first()[0] == 20


def test_stores_have_their_own_day(spark, cogs, tmp_path):
    """A Tokyo store's order and report of the same local day meet, though their UTC dates differ."""
    import json

    wh = Warehouse(spark, str(tmp_path / "w"), "salt")
    stores = spark.createDataFrame([("store_001", "Asia/Tokyo")], "merchant_id string, store_tz string")
    order = samples.order("a", [("X", 1, 60), ("Y", 1, 40)], at="2026-06-09T20:00:00Z", total=100)
    result = json.loads(json.dumps(samples.RESULT))
    result["result"].update(period_start="2026-06-09T15:00:00Z", totals={
        "gross_sales": {"amount": 100, "currency": "USD"}, "net_payout": {"amount": 80, "currency": "USD"}})
    root = tmp_path / "files"
    samples.write_file(root, "reports_enqueue", samples.ENQUEUE)
    samples.write_file(root, "reports_result", result)
    build(wh, orders=samples.bronze(spark, [samples.landing_row([order])]), cogs=cogs, stores=stores,
          enqueue=read_bronze(spark, str(root), "reports_enqueue", "files"),
          result=read_bronze(spark, str(root), "reports_result", "files"))
    rows = wh.read("served_fact").orderBy("line_item_no").collect()
    assert [(r.report_date, r.net_payout_amount, r.settlement_variance_amount, r.variance_reason) for r in rows] == [
        (dt.date(2026, 6, 10), 48, 3, "PAYOUT_SHORT"), (dt.date(2026, 6, 10), 32, 2, "PAYOUT_SHORT")]


def test_landing_without_merchant_directories(spark, tmp_path):
    from tablemargin.sources.bronze import DAILY

    root = str(tmp_path / "landing")
    write_bronze(samples.landing(spark, [r for rows in rounds() for r in rows]), root, DAILY)
    got = flatten.silver_orders(read_bronze(spark, root, "orders"), "s")
    assert sorted((r.order_id, r.merchant_id)
                  for r in got.collect()) == [
        ("a", "store_001"), ("b", "store_001"), ("old", "store_001"), ("y", "store_002"), ("z", "store_002")]


def silver(batch):
    return flatten.silver_orders(batch, "salt")


def run_stream(spark, stream, base):
    stream_merge(stream, str(base / "table"), flatten.ORDER_KEY, ["merchant_id"], str(base / "log"), silver,
                 version="run_timestamp_utc").awaitTermination()
    return spark.read.parquet(str(base / "table"))


def test_stream_processes_each_file_once(spark, tmp_path):
    root = str(tmp_path / "landing")
    for rows in rounds():
        write_bronze(samples.landing(spark, rows), root)
        got = run_stream(spark, stream_bronze(spark, root, "orders"), tmp_path)
    assert sorted((r.order_id, r.line_item_sku, r.total_amount) for r in got.collect()) == [
        ("a", "X", 90), ("b", "X", 1000), ("old", "X", 1000), ("y", "Y", 1000), ("z", "Y", 1000)]


def test_late_older_run_does_not_win(spark, tmp_path):
    root = str(tmp_path / "landing")
    for rows in reversed(rounds()[:2]):
        write_bronze(samples.landing(spark, rows), root)
        got = run_stream(spark, stream_bronze(spark, root, "orders"), tmp_path)
    assert [r.total_amount for r in got.where("order_id = 'a'").collect()] == [90]


def test_replaying_the_stream_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "landing")
    write_bronze(samples.landing(spark, rounds()[0]), root)
    for log in ("log1", "log2"):
        stream_merge(stream_bronze(spark, root, "orders"), str(tmp_path / "t"), flatten.ORDER_KEY, ["merchant_id"],
                     str(tmp_path / log), silver, version="run_timestamp_utc").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_stream_of_json_files(spark, tmp_path):
    root = tmp_path / "files"
    samples.write_file(root, "orders", samples.ORDERS_PAGE)
    got = run_stream(spark, stream_bronze_files(spark, str(root), "orders"), tmp_path)
    samples.write_file(root, "orders", {"orders": [samples.order("n", [("X", 1, 1)])]}, run="20260612T000000Z")
    got = run_stream(spark, stream_bronze_files(spark, str(root), "orders", 1), tmp_path)
    assert sorted(r.order_id for r in got.collect()) == ["n", "ord_001", "ord_002"]
