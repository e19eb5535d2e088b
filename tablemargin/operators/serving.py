"""Tenant-fenced reads and the figures shown to a merchant."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablemargin.functions.money import percent_tenths
from tablemargin.schemas import COGS_LEDGER, DIM_MENU_CATALOG
from tablemargin.sources.tables import table_or_empty

SERVED_FACT = [
    "order_id", "source_marketplace", "line_item_sku", "gross_order_value", "net_payout_amount",
    "true_net_payout_margin", "estimated_marketplace_commission", "settlement_variance_amount",
]


def require_tenant(merchant_id: str | None) -> str:
    """The trimmed tenant id; a blank one is refused before any data is read."""
    cleaned = (merchant_id or "").strip()
    if not cleaned:
        raise ValueError("merchant_id is required")
    return cleaned


def tenant(df: DataFrame, *, merchant_id: str) -> DataFrame:
    """Rows of one merchant; on a table partitioned by merchant only its directories are read."""
    return df.where(F.col("merchant_id") == F.lit(require_tenant(merchant_id)))


def list_menu_items(dim: DataFrame, *, merchant_id: str) -> DataFrame:
    return tenant(dim, merchant_id=merchant_id).select("line_item_sku", "line_item_name")


def list_merchant_cogs(ledger: DataFrame, *, merchant_id: str) -> DataFrame:
    """One merchant's ledger costs, as doubles in major units."""
    return tenant(ledger, merchant_id=merchant_id).select(
        "line_item_sku",
        F.col("recipe_cost").cast("double").alias("recipe_cost"),
        F.col("packaging_cost").cast("double").alias("packaging_cost"))


def list_fact_financial_sales(fact: DataFrame, *, merchant_id: str) -> DataFrame:
    """One merchant's served fact rows; a row without a reason has an empty one."""
    money = SERVED_FACT[3:]
    return tenant(fact, merchant_id=merchant_id).select(
        *SERVED_FACT[:3], *[F.col(c).cast("double").alias(c) for c in money],
        F.coalesce("variance_reason", F.lit("")).alias("variance_reason"))


class GoldTables:
    """The same reads by catalog table name; a table that does not exist yet reads as empty.

    Sales are read from `served_fact`, the model that holds payouts and variances.
    """

    def __init__(self, spark: SparkSession, database: str = "default"):
        self.spark, self.database = spark, database

    def _table(self, name, schema):
        return table_or_empty(self.spark, f"{self.database}.{name}", schema)

    def list_menu_items(self, *, merchant_id: str) -> DataFrame:
        return list_menu_items(self._table("dim_menu_catalog", DIM_MENU_CATALOG), merchant_id=merchant_id)

    def list_merchant_cogs(self, *, merchant_id: str) -> DataFrame:
        return list_merchant_cogs(self._table("merchant_cogs", COGS_LEDGER), merchant_id=merchant_id)

    def list_fact_financial_sales(self, *, merchant_id: str) -> DataFrame:
        empty = "merchant_id string, order_id string, source_marketplace string, line_item_sku string, " + \
            ", ".join(f"{c} bigint" for c in SERVED_FACT[3:]) + ", variance_reason string"
        return list_fact_financial_sales(self._table("served_fact", empty), merchant_id=merchant_id)


def kpis(fact: DataFrame, by: str | None = None) -> DataFrame:
    """Net margin %, blended commission %, and number of settlement variances.

    One row over all of `fact`, or one per value of `by`.  Over no rows the single row holds
    NULLs.  Rows without a variance figure are counted apart as `unreconciled_count`.
    """
    gross, margin, fee = (F.col(c) for c in ("gross_total", "margin_total", "commission_total"))
    sums = fact.groupBy(*([by] if by else [])).agg(
        F.sum("gross_order_value").alias("gross_total"),
        F.sum("true_net_payout_margin").alias("margin_total"),
        F.sum("estimated_marketplace_commission").alias("commission_total"),
        F.count_if(F.col("settlement_variance_amount") != 0).alias("variance_count"),
        F.count_if(F.col("settlement_variance_amount").isNull()).alias("unreconciled_count"))
    return sums.select(
        *([by] if by else []), "gross_total", "margin_total", "commission_total",
        percent_tenths(margin, gross).alias("net_margin_pct"),
        percent_tenths(fee, gross).alias("commission_pct"),
        "variance_count", "unreconciled_count")


def profit_leakage(fact: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Gross sales, net payout and true profit per marketplace (within `by`, if given)."""
    return fact.groupBy(*(by or []), "source_marketplace").agg(
        F.sum("gross_order_value").alias("gross_sales"),
        F.sum("net_payout_amount").alias("net_payout"),
        F.sum("true_net_payout_margin").alias("true_profit"))


def menu_engineering(
    fact: DataFrame, target_pct: float | str | None = None, k: int | None = None, by: list[str] | None = None
) -> DataFrame:
    """Net profit per SKU, most profitable first; ties by SKU.

    With `target_pct` each SKU also gets its lines, gross, margin % and whether that falls below
    the target, and the units sold where the fact holds them.  With `k` only the k most profitable
    SKUs are kept.
    """
    keys = [*(by or []), "line_item_sku"]
    aggs = [F.sum("true_net_payout_margin").alias("net_profit")]
    if target_pct is not None:
        aggs += [F.count(F.lit(1)).alias("line_count"), F.sum("gross_order_value").alias("gross_sales")]
        if "units_sold" in fact.columns:
            aggs.append(F.sum("units_sold").alias("units_sold"))
    ranked = fact.groupBy(*keys).agg(*aggs)
    if target_pct is not None:
        target = Decimal(str(target_pct))
        ranked = ranked.withColumns({
            "margin_pct": percent_tenths(F.col("net_profit"), F.col("gross_sales")),
            "below_target": F.col("net_profit").cast("decimal(25,0)") * F.lit(Decimal(100))
            < F.col("gross_sales").cast("decimal(25,0)") * F.lit(target),
        })
    ranked = ranked.orderBy(F.col("net_profit").desc(), *keys)
    return ranked.limit(k) if k is not None else ranked


def variance_log(fact: DataFrame) -> DataFrame:
    """Rows whose payout differs from what was expected."""
    return fact.where(F.col("settlement_variance_amount") != 0).select(
        "order_id", "source_marketplace", "gross_order_value", "net_payout_amount",
        "settlement_variance_amount", F.coalesce("variance_reason", F.lit("")).alias("variance_reason"))


def menu_cogs_grid(dim: DataFrame, cogs: DataFrame) -> DataFrame:
    """Every menu item with its stored costs, 0.0 where none are stored yet."""
    costs = cogs.select("merchant_id", "line_item_sku", "recipe_cost", "packaging_cost")
    return dim.join(costs, ["merchant_id", "line_item_sku"], "left").select(
        "merchant_id", "line_item_sku", "line_item_name",
        F.coalesce(F.col("recipe_cost").cast("double"), F.lit(0.0)).alias("recipe_cost"),
        F.coalesce(F.col("packaging_cost").cast("double"), F.lit(0.0)).alias("packaging_cost"))
