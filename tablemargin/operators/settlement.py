"""Payout reconciliation: what the orders say against what the reports paid."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from tablemargin.functions.money import COMMISSION_RATE, commission
from tablemargin.functions.times import local_date
from tablemargin.operators.allocate import allocate
from tablemargin.sources.tables import stage_to_join

DAY_KEY = ["merchant_id", "report_date"]


def _code(currency: str) -> Column:
    """Currency as a number, NULL for NULL: min and max of strings would rule out hash aggregation."""
    return F.when(F.col(currency).isNotNull(), F.xxhash64(currency))


def settlement_reconciliation(
    headers: DataFrame, reports: DataFrame, rate: Decimal | str = COMMISSION_RATE,
    tz: str | Column = "UTC", day: str | None = None,
) -> DataFrame:
    """Daily order totals per merchant against the daily payout reports.

    `headers` holds one row per order, `reports` one per job; both are summed per merchant and
    store-local day before the full outer join, so the join sees one row per merchant-day a side.
    The day of an order is its `day` column, or that of `created_at` in zone `tz`.
    expected_net = gross - commission; a positive variance is money not paid out.  The reason is
    the first that applies: MISSING_REPORT, MISSING_ORDERS, CURRENCY_MISMATCH, REPORT_NOT_READY,
    GROSS_MISMATCH, PAYOUT_SHORT, PAYOUT_OVER, or empty.
    """
    sold = headers.withColumn("report_date", _day_of(day, tz)).groupBy(*DAY_KEY).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").alias("order_gross"),
        F.sum(commission("total_amount", rate)).alias("order_commission"),
        F.min(_code("total_currency")).alias("_low"), F.max(_code("total_currency")).alias("_high"))
    paid = reports.groupBy(*DAY_KEY).agg(
        F.count(F.lit(1)).alias("report_count"),
        F.count_if(F.col("result_status") == "READY").alias("_ready"),
        F.sum("gross_sales_amount").alias("reported_gross"),
        F.sum("net_payout_amount").alias("net_payout_amount"),
        F.min(F.least(_code("gross_sales_currency"), _code("net_payout_currency"))).alias("_rlow"),
        F.max(F.greatest(_code("gross_sales_currency"), _code("net_payout_currency"))).alias("_rhigh"))
    both = sold.join(paid, DAY_KEY, "full_outer").withColumn(
        "expected_net", F.col("order_gross") - F.col("order_commission"))
    both = both.withColumn("settlement_variance_amount", F.col("expected_net") - F.col("net_payout_amount"))
    variance = F.col("settlement_variance_amount")
    reason = (
        F.when(F.col("report_count").isNull(), "MISSING_REPORT")
        .when(F.col("order_count").isNull(), "MISSING_ORDERS")
        .when((F.col("_low") != F.col("_high")) | (F.col("_rlow") != F.col("_rhigh"))
              | (F.col("_low") != F.col("_rlow")), "CURRENCY_MISMATCH")
        .when((F.col("_ready") < F.col("report_count")) | variance.isNull(), "REPORT_NOT_READY")
        .when(F.col("order_gross") != F.col("reported_gross"), "GROSS_MISMATCH")
        .when(variance > 0, "PAYOUT_SHORT")
        .when(variance < 0, "PAYOUT_OVER")
        .otherwise("")
    )
    return both.select(
        *DAY_KEY, "order_count", "order_gross", "order_commission", "expected_net",
        "reported_gross", "net_payout_amount", "settlement_variance_amount", reason.alias("variance_reason"))


def _day_of(day: str | None, tz: str | Column) -> Column:
    return F.col(day) if day else local_date("created_at", tz)


def fact_with_settlement(
    fact: DataFrame, reconciliation: DataFrame, tz: str | Column = "UTC", day: str | None = None, place: str | None = None
) -> DataFrame:
    """The fact with its part of each day's payout and variance.

    Both daily figures are split over the day's lines by gross value, to the cent, in order of
    order_id; a merchant-day without a report keeps NULLs (not reconciled).  `fact` should be the
    allocated one: with an order's total on each of its lines an order weighs as often as it has lines.
    `place` names a column of it that orders lines alike in number, SKU and margin, the last first, and is left out;
    without it such lines may swap their parts.
    """
    days = stage_to_join(reconciliation.select(
        *DAY_KEY, F.col("net_payout_amount").alias("_net"),
        F.col("settlement_variance_amount").alias("_variance"), "variance_reason"), "settled-days")
    dated = fact.withColumn("report_date", _day_of(day, tz)).join(days, DAY_KEY, "left")
    unit = ["order_id", "source_marketplace"]
    rest = [c for c in ("line_item_no", "line_item_sku", "true_net_payout_margin") if c in fact.columns]
    numbered = rest[:1] == ["line_item_no"]
    rest += [F.col(place).desc()] if place else []
    split = allocate(
        dated, {"net_payout_amount": "_net", "settlement_variance_amount": "_variance"}, "gross_order_value", DAY_KEY, unit + rest,
        unit=unit if numbered else None, page="line_item_no" if numbered else None)
    return split.drop("_net", "_variance", *([place] if place else []))


def variance_by_settlement_date(settled: DataFrame) -> DataFrame:
    """Audit totals per merchant and settlement date: the orders on days that do not balance.

    `settled` holds order lines with their part of the day's variance (`fact_with_settlement`).
    """
    orders = settled.where(F.col("variance_reason") != "").groupBy(
        *DAY_KEY, "variance_reason", "order_id", "source_marketplace").agg(
        F.sum("settlement_variance_amount").alias("variance"), F.sum("gross_order_value").alias("gross"))
    return orders.groupBy(*DAY_KEY, "variance_reason").agg(
        F.count(F.lit(1)).alias("exceptions"), F.sum("gross").alias("gross_order_value"),
        F.sum("variance").alias("settlement_variance_amount"))
