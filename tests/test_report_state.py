"""Requests and results in any order and any windows give one table."""

import datetime as dt
import itertools
import json
import random

import pytest

import samples
from tablemargin.operators import quality
from tablemargin.operators.reports import silver_reports
from tablemargin.plans.build import Warehouse, build
from tablemargin.sources.bronze import read_bronze, write_bronze
from tablemargin.sources.tables import exists

HOUR = dt.timedelta(hours=1)


def request(job, hours=0, status="QUEUED", merchant="store_001"):
    return (merchant, "reports_enqueue", dt.date(2026, 6, 9), samples.RUN + hours * HOUR, json.dumps({"jobId": job, "status": status}))


def result(job, hours=0, net=800, status="READY", merchant="store_001"):
    money = lambda a: {"amount": a, "currency": "USD"}
    figures = {"store_id": merchant, "period_start": "2026-06-09T00:00:00Z", "period_end": "2026-06-09T23:59:59Z",
               "totals": {"gross_sales": money(1000), "net_payout": money(net)}}
    return (merchant, "reports_result", dt.date(2026, 6, 9), samples.RUN + hours * HOUR,
            json.dumps({"jobId": job, "status": status, "result": figures if status == "READY" else None}))


DOCUMENTS = [request("a"), result("a"), request("a", 2, "REQUEUED"), result("b"), request("b", 5), request("c"), result("c", 1, status="PENDING"),
             result("c", 3, 700), result("c", 2, 600), result("d", 4), request("e", 1, merchant="store_002")]


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def frames(spark, documents):
    """Documents by endpoint, parsed, without landing files."""
    import pyspark.sql.functions as F

    from tablemargin.schemas import ENDPOINT_SCHEMAS

    out = {}
    for name, endpoint in (("enqueue", "reports_enqueue"), ("result", "reports_result")):
        mine = [(m, d, r, p) for m, e, d, r, p in documents if e == endpoint]
        if mine:
            df = spark.createDataFrame(mine, "path_merchant_id string, path_date date, run_timestamp_utc timestamp_ntz, payload string")
            out[name] = df.select("path_merchant_id", "path_date", "run_timestamp_utc",
                                  F.from_json("payload", ENDPOINT_SCHEMAS[endpoint]).alias("d")).select(
                "path_merchant_id", "path_date", "run_timestamp_utc", "d.*")
    return out


@pytest.fixture(scope="module")
def whole(spark):
    given = frames(spark, DOCUMENTS)
    return rows(silver_reports(given["enqueue"], given["result"]))


@pytest.mark.parametrize("seed", range(3))
def test_any_order_and_any_window(spark, tmp_path, whole, seed):
    rng = random.Random(seed)
    documents = DOCUMENTS + rng.sample(DOCUMENTS, 3)
    rng.shuffle(documents)
    cuts = sorted(rng.sample(range(1, len(documents)), 4))
    wh = Warehouse(spark, str(tmp_path), "salt")
    for a, b in zip([0, *cuts], [*cuts, len(documents)]):
        build(wh, select=["silver_reports"], **frames(spark, documents[a:b]))
    assert rows(wh.read("silver_reports")) == whole
    figures = {r.job_id: r.net_payout_amount for r in wh.read("silver_reports").collect()}
    # A request seen again leaves the payout, a later result replaces an earlier one, one without its request waits.
    assert figures == {"a": 800, "b": 800, "c": 700, "e": None}


def test_landing_files_are_read_once(spark, tmp_path):
    root, wh = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "wh"), "salt")

    def land_and_build(documents, marks=True):
        write_bronze(samples.landing(spark, documents), root)
        given = {n: read_bronze(spark, root, e, modified_after=wh.landing_mark(e) if marks else None)
                 for n, e in (("enqueue", "reports_enqueue"), ("result", "reports_result"))}
        return {(r.table_name, r.check_name) for r in build(wh, select=["silver_reports"], **given).collect()}

    ran = land_and_build([result("a"), request("b")])
    assert ("bronze_reports_result", "document_parsed") in ran and ("bronze_reports_enqueue", "document_parsed") in ran
    land_and_build([request("a", 1)])
    land_and_build([result("b", 2)])
    got = {r.job_id: (r.net_payout_amount, r.merchant_id) for r in wh.read("silver_reports").collect()}
    assert got == {"a": (800, "store_001"), "b": (800, "store_001")}
    for endpoint, files in (("reports_enqueue", 2), ("reports_result", 2)):
        assert wh.read(f"_progress/{endpoint}").count() == files


@pytest.mark.parametrize("broken", ["reports_enqueue", "reports_result"])
def test_broken_documents_stop_the_build(spark, tmp_path, broken):
    root, wh = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "wh"), "salt")
    good = [request("a"), result("a")]
    write_bronze(samples.landing(spark, [(m, e, d, r, p[:len(p) // 2] if e == broken else p) for m, e, d, r, p in good]), root)
    with pytest.raises(quality.QualityError, match=f"bronze_{broken}.document_parsed: 1"):
        build(wh, select=["silver_reports"], enqueue=read_bronze(spark, root, "reports_enqueue"), result=read_bronze(spark, root, "reports_result"))
    assert not exists(spark, wh.path("silver_reports")) and not exists(spark, wh.path(f"_progress/{broken}"))


def test_full_refresh_takes_only_what_is_given(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), "salt")
    given = frames(spark, DOCUMENTS)
    build(wh, select=["silver_reports"], **given)
    build(wh, select=["silver_reports"], full_refresh=True, **frames(spark, [request("a"), result("a", net=5)]))
    assert [(r.job_id, r.net_payout_amount) for r in wh.read("silver_reports").collect()] == [("a", 5)]
    # Results that are not given are those known before.
    build(wh, select=["silver_reports"], full_refresh=True, **frames(spark, [request("a"), request("f")]))
    assert sorted((r.job_id, r.net_payout_amount) for r in wh.read("silver_reports").collect()) == [("a", 5), ("f", None)]
    assert all(x for x in itertools.chain([wh.landing_mark("reports_enqueue")]))
