"""Gates over the whole table, each broken by a second build."""

import datetime as dt
import os

import pytest

import samples
from tablemargin.functions import pii
from tablemargin.operators import quality
from tablemargin.operators.key_index import KeyIndex
from tablemargin.plans.build import Warehouse, build
from tablemargin.schemas import COGS_SEED

DAY = dt.timedelta(days=1)


def docs(spark, orders, merchant="store_001", run=samples.RUN):
    return samples.bronze(spark, [samples.landing_row(orders, run=run, merchant=merchant)])


def order(name, store="store_001", total=100):
    return samples.order(name, [("X", 1, total or 0)], total=total, store=store)


def held(wh):
    return sorted((r.order_id, r.merchant_id, r.total_amount) for r in wh.read("silver_orders").collect())


def test_an_order_of_another_merchant_is_refused(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), "salt")
    build(wh, orders=docs(spark, [order("a"), order("b")]), select=["silver_orders"])
    build(wh, orders=docs(spark, [order("c")], run=samples.RUN + DAY), select=["silver_orders"])
    before = held(wh)
    with pytest.raises(quality.QualityError, match="unique_in_table_order_id_source_marketplace: 1"):
        build(wh, orders=docs(spark, [order("a", "store_002"), order("d", "store_002")], "store_002"), select=["silver_orders"])
    assert held(wh) == before
    # Emptied by a later run, the id is free.
    build(wh, orders=docs(spark, [samples.order("a", [], total=0)], run=samples.RUN + DAY), select=["silver_orders"])
    build(wh, orders=docs(spark, [order("a", "store_002")], "store_002"), select=["silver_orders"])
    assert [r for r in held(wh) if r[0] == "a"] == [("a", "store_002", 100)]


def test_a_table_without_index_gets_one(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), "salt")
    build(wh, orders=docs(spark, [order("a")]), select=["silver_orders"])
    os.rename(f"{tmp_path}/_index", f"{tmp_path}/_index_away")
    with pytest.raises(quality.QualityError, match="unique_in_table"):
        build(wh, orders=docs(spark, [order("a", "store_002")], "store_002"), select=["silver_orders"])


def test_lookup_reads_only_the_buckets_of_the_keys(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), ["k"], ["owner"], buckets=32)
    index.rebuild(spark.range(10_000).selectExpr("cast(id as string) k", "'m' owner"))
    new = spark.createDataFrame([("17", "x"), ("18", "m"), ("none", "x"), (None, "x")], "k string, owner string")
    found = index.conflicts(new)
    assert [tuple(r) for r in found.collect()] == [("17", "x", "m")]
    files = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in files and "_bucket" in files


def test_path_of_another_merchant(spark, tmp_path):
    wrong = docs(spark, [order("a", "store_009")], "store_001")
    with pytest.raises(quality.QualityError, match="path_merchant_is_payload_merchant: 1"):
        build(Warehouse(spark, str(tmp_path / "a"), "salt"), orders=wrong, select=["silver_orders"])
    results = build(Warehouse(spark, str(tmp_path / "b"), "salt", isolation="warn"), orders=wrong, select=["silver_orders"])
    assert [r.failing_rows for r in results.where("check_name = 'path_merchant_is_payload_merchant'").collect()] == [1]


def test_missing_totals_are_set_aside(spark, tmp_path):
    missing = order("a", total=None)
    with pytest.raises(quality.QualityError, match="not_null_total_amount"):
        build(Warehouse(spark, str(tmp_path / "a"), "salt"), orders=docs(spark, [missing]), select=["silver_orders"])
    wh = Warehouse(spark, str(tmp_path / "b"), "salt", quarantine=True)
    build(wh, orders=docs(spark, [missing, order("b")], run=samples.RUN + DAY), select=["silver_orders"])
    build(wh, orders=docs(spark, [order("c", total=None)]), select=["silver_orders"])
    assert held(wh) == [("a", "store_001", 0), ("b", "store_001", 100), ("c", "store_001", 0)]
    # An older run says nothing any more, a later one does.
    build(wh, orders=docs(spark, [order("a"), order("b", total=None)]), select=["silver_orders"])
    assert sorted(r.order_id for r in wh.anomalies().read().collect()) == ["a", "c"]
    build(wh, orders=docs(spark, [order("a")], run=samples.RUN + 2 * DAY), select=["silver_orders"])
    assert [r.order_id for r in wh.anomalies().read().collect()] == ["c"]


def test_taken_up_changes_are_forgotten(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), "salt")
    cogs = spark.createDataFrame([("store_001", "X", 10, 1)], COGS_SEED)
    changes = f"{tmp_path}/_changes"

    def batches():
        return len([f for f in os.listdir(changes) if f.startswith("batch=")])

    build(wh, orders=docs(spark, [order("a")]), cogs=cogs)
    assert batches() == 0
    build(wh, orders=docs(spark, [order("b")], run=samples.RUN + DAY), cogs=cogs, select=["silver_orders", "fact_financial_sales"])
    assert batches() == 1
    build(wh, orders=docs(spark, [order("c")], run=samples.RUN + 2 * DAY), cogs=cogs)
    assert batches() == 0
    assert sorted(r.order_id for r in wh.read("served_fact").collect()) == ["a", "b", "c"]


def test_salts_of_a_tenant(spark):
    salts = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", None)], "merchant_id string, pii_salt string")
    hashed, rejects = pii.salted_hash_by_tenant(spark.createDataFrame([("a", "x"), ("b", "y")], "merchant_id string, name string"), salts, ["name"])
    assert hashed.count() == 1 and rejects.count() == 1
    failed = {(r.check_name, r.failing_rows) for r in quality.check_salts(salts).collect()}
    assert failed == {("not_null_merchant_id", 0), ("not_null_pii_salt", 1), ("unique_merchant_id", 1)}
