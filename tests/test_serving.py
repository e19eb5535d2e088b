import pytest

import samples
from samples import records
from tablemargin.operators import serving
from tablemargin.schemas import DIM_MENU_CATALOG


@pytest.fixture()
def fact(spark):
    return spark.createDataFrame(samples.SERVED_FACT, samples.SERVED_SCHEMA)


@pytest.mark.parametrize("blank", ["", "   ", None])
def test_blank_tenant_is_refused(fact, blank):
    with pytest.raises(ValueError):
        serving.tenant(fact, merchant_id=blank)


def test_tenant_is_a_mandatory_keyword(fact):
    with pytest.raises(TypeError):
        serving.tenant(fact, "store_001")
    with pytest.raises(TypeError):
        serving.list_fact_financial_sales(fact)


def test_no_tenant_sees_another(fact):
    for merchant in ("store_001", "store_002", "store_003"):
        orders = {r["order_id"] for r in records(serving.list_fact_financial_sales(fact, merchant_id=merchant))}
        assert orders == {r[1] for r in samples.SERVED_FACT if r[0] == merchant}


def test_kpis_over_nothing(fact):
    (kpi,) = records(serving.kpis(serving.tenant(fact, merchant_id="nobody")))
    assert kpi["gross_total"] is None and kpi["net_margin_pct"] is None and kpi["variance_count"] == 0


def test_kpis_of_worthless_sales(fact):
    (kpi,) = records(serving.kpis(fact.selectExpr("* except(gross_order_value)", "0L gross_order_value")))
    assert (kpi["net_margin_pct"], kpi["commission_pct"]) == (0.0, 0.0)


def test_negative_margin_rounds_away_from_zero(spark):
    fact = spark.createDataFrame([("m", "o", "c", "s", 2000, 0, -1, 1, None, None)], samples.SERVED_SCHEMA)
    (kpi,) = records(serving.kpis(fact))
    assert (kpi["net_margin_pct"], kpi["commission_pct"]) == (-0.1, 0.1)
    assert (kpi["variance_count"], kpi["unreconciled_count"]) == (0, 1)


def test_menu_target_and_top_k(fact):
    rows = serving.menu_engineering(fact, target_pct=60, k=2).collect()
    assert [(r.line_item_sku, r.net_profit, r.margin_pct, r.below_target) for r in rows] == [
        ("BURGER", 33, 60.0, False), ("PIZZA", 28, 70.0, False)]
    below = {r.line_item_sku for r in serving.menu_engineering(fact, target_pct=60).collect() if r.below_target}
    assert below == {"FRIES", "COLA"}


def test_missing_tables_read_as_empty(spark):
    gold = serving.GoldTables(spark, "default")
    assert gold.list_menu_items(merchant_id="m").collect() == []
    assert gold.list_merchant_cogs(merchant_id="m").collect() == []
    assert gold.list_fact_financial_sales(merchant_id="m").collect() == []
    spark.createDataFrame([("m", "S", "Soup", None, None), ("x", "T", "Tea", None, None)],
                          DIM_MENU_CATALOG).write.saveAsTable("dim_menu_catalog")
    try:
        assert [tuple(r) for r in gold.list_menu_items(merchant_id="m").collect()] == [("S", "Soup")]
    finally:
        spark.sql("drop table dim_menu_catalog")


def test_grid_shows_stored_costs(spark):
    dim = spark.createDataFrame([("m", "S", "Soup", None, None), ("m", "T", "Tea", None, None)], DIM_MENU_CATALOG)
    ledger = spark.sql("select 'm' merchant_id, 'S' line_item_sku, cast(3.5 as decimal(10,4)) recipe_cost, "
                       "cast(1 as decimal(10,4)) packaging_cost, timestamp_ntz'2026-01-01' updated_at")
    rows = {r["line_item_sku"]: (r["recipe_cost"], r["packaging_cost"])
            for r in records(serving.menu_cogs_grid(dim, ledger))}
    assert rows == {"S": (3.5, 1.0), "T": (0.0, 0.0)}
