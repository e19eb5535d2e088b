"""Payout reconciliation and the figures that need it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemargin.operators import serving, settlement, star
from tablemargin.plans.registry import query
from tablemargin.plans.shared_tables import sql_pct
from tablemargin.session import delete_scratch, scratch_noted

TENANT = "store_007"


def _recon(t):
    return settlement.settlement_reconciliation(t.headers(), t.reports())


def _settled(t, merchant_id=None):
    """Allocated sales with their part of payout and variance; of one tenant, if named, from the inputs on."""
    def fenced(df):
        return df if merchant_id is None else serving.tenant(df, merchant_id=merchant_id)

    recon = settlement.settlement_reconciliation(fenced(t.headers()), fenced(t.reports()))
    with scratch_noted() as used:
        fact = star.allocated_fact(fenced(t.lines()), fenced(t.cogs()), place="_place", staged=True)
    settled = settlement.fact_with_settlement(fact, recon, place="_place")
    # The settled fact reads what it staged itself.
    delete_scratch(t.spark, used)
    return settled


@query("SELECT * FROM recon", ("recon",))
def settlement_reconciliation(t):
    return _recon(t)


@query("SELECT * FROM settled", ("settled",))
def fact_with_settlement(t):
    return _settled(t)


@query("""SELECT merchant_id, report_date, variance_reason,
                 count(DISTINCT (order_id, source_marketplace)) AS exceptions,
                 CAST(sum(gross_order_value) AS BIGINT) AS gross_order_value,
                 CAST(sum(settlement_variance_amount) AS BIGINT) AS settlement_variance_amount
          FROM settled WHERE variance_reason <> '' GROUP BY 1, 2, 3""", ("settled",))
def variance_by_settlement_date(t):
    return settlement.variance_by_settlement_date(_settled(t))


@query("""SELECT order_id, source_marketplace, gross_order_value, net_payout_amount, settlement_variance_amount,
                 variance_reason FROM settled WHERE settlement_variance_amount <> 0""", ("settled",))
def variance_log(t):
    return serving.variance_log(_settled(t))


@query(f"""SELECT order_id, source_marketplace, line_item_sku,
                  CAST(gross_order_value AS DOUBLE) AS gross_order_value,
                  CAST(net_payout_amount AS DOUBLE) AS net_payout_amount,
                  CAST(true_net_payout_margin AS DOUBLE) AS true_net_payout_margin,
                  CAST(estimated_marketplace_commission AS DOUBLE) AS estimated_marketplace_commission,
                  CAST(settlement_variance_amount AS DOUBLE) AS settlement_variance_amount,
                  coalesce(variance_reason, '') AS variance_reason
           FROM settled WHERE merchant_id = '{TENANT}'""", ("settled",))
def list_fact_financial_sales(t):
    return serving.list_fact_financial_sales(_settled(t, TENANT), merchant_id=TENANT)


_KPI = f"""SELECT %s gross_total, margin_total, commission_total,
                  {sql_pct('margin_total', 'gross_total')} AS net_margin_pct,
                  {sql_pct('commission_total', 'gross_total')} AS commission_pct, variance_count, unreconciled_count
           FROM (SELECT %s CAST(sum(gross_order_value) AS BIGINT) AS gross_total,
                        CAST(sum(true_net_payout_margin) AS BIGINT) AS margin_total,
                        CAST(sum(estimated_marketplace_commission) AS BIGINT) AS commission_total,
                        count_if(settlement_variance_amount <> 0) AS variance_count,
                        count_if(settlement_variance_amount IS NULL) AS unreconciled_count
                 FROM settled %s)"""


@query(_KPI % ("", "", f"WHERE merchant_id = '{TENANT}'"), ("settled",))
def kpi_tenant(t):
    return serving.kpis(serving.tenant(_settled(t, TENANT), merchant_id=TENANT))


@query(_KPI % ("merchant_id,", "merchant_id,", "GROUP BY merchant_id"), ("settled",))
def kpi_by_merchant(t):
    return serving.kpis(_settled(t), by="merchant_id")


@query("""SELECT merchant_id, source_marketplace, CAST(sum(gross_order_value) AS BIGINT) AS gross_sales,
                 CAST(sum(net_payout_amount) AS BIGINT) AS net_payout,
                 CAST(sum(true_net_payout_margin) AS BIGINT) AS true_profit
          FROM settled GROUP BY 1, 2""", ("settled",))
def profit_leakage(t):
    return serving.profit_leakage(_settled(t), by=["merchant_id"])


@query("""SELECT report_date, CAST(sum(net_payout_amount) AS BIGINT) AS paid,
                 CAST(sum(settlement_variance_amount) AS BIGINT) AS variance
          FROM settled GROUP BY 1""", ("settled",))
def payout_by_day(t):
    return _settled(t).groupBy("report_date").agg(
        F.sum("net_payout_amount").alias("paid"), F.sum("settlement_variance_amount").alias("variance"))
