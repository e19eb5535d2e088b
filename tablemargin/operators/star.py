"""Star schema: menu dimension and sales fact."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from tablemargin.functions.money import COMMISSION_RATE, commission
from tablemargin.operators.allocate import allocate
from tablemargin.sources.tables import stage

ITEM_KEY = ["merchant_id", "line_item_sku"]


def dim_menu_catalog(silver: DataFrame, name: str = "min") -> DataFrame:
    """One row per (merchant, SKU) with the time range it was seen in.

    name = "min"   alphabetically first name
           "mode"  most frequent name, ties to the alphabetically first
    """
    if name not in ("min", "mode"):
        raise ValueError(f"unknown name rule {name!r}")
    # Per name first, which hash aggregation can do: a string in a min or max buffer would sort all lines.
    per_name = silver.groupBy(*ITEM_KEY, "line_item_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("created_at").alias("first"), F.max("created_at").alias("last"))
    if name == "min":
        return per_name.groupBy(*ITEM_KEY).agg(
            F.min("line_item_name").alias("line_item_name"),
            F.min("first").alias("first_seen_at"), F.max("last").alias("last_seen_at"))
    best = F.min(F.when(F.col("line_item_name").isNotNull(),
                        F.struct((-F.col("n")).alias("n"), F.col("line_item_name").alias("name"))))
    return per_name.groupBy(*ITEM_KEY).agg(
        best["name"].alias("line_item_name"),
        F.min("first").alias("first_seen_at"), F.max("last").alias("last_seen_at"))


def join_cogs(lines: DataFrame, cogs: DataFrame) -> DataFrame:
    """Lines with their costs; a SKU without costs gets 0, no line is dropped.

    No broadcast is forced: the planner broadcasts the costs when their measured size allows,
    otherwise the sort-merge join can be split on a hot (merchant, SKU).  Several cost rows of one
    SKU count as their largest, so they double no line; `check_cogs` reports them.
    """
    costs = cogs.groupBy(*ITEM_KEY).agg(
        F.max("recipe_cost").alias("recipe_cost"), F.max("packaging_cost").alias("packaging_cost"))
    return lines.join(costs, ITEM_KEY, "left").withColumns({
        "recipe_cost": F.coalesce("recipe_cost", F.lit(0)).cast("bigint"),
        "packaging_cost": F.coalesce("packaging_cost", F.lit(0)).cast("bigint"),
    })


def fact_financial_sales(
    silver: DataFrame, cogs: DataFrame, rate: Decimal | str = COMMISSION_RATE, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per order line with commission, costs and margin.

    Gross is the order total on every line, and commission and costs are charged per line, so a
    sum over an order with several lines counts its total several times; see
    `allocated_fact` for figures that add up.  `keep` names further line columns to carry along.
    """
    gross, fee = F.col("total_amount"), F.col("_fee")
    recipe, packaging = F.col("recipe_cost"), F.col("packaging_cost")
    return join_cogs(silver, cogs).withColumn("_fee", commission("total_amount", rate)).select(
        "merchant_id", "order_id", "source_marketplace", "line_item_no", "line_item_sku", "created_at", *keep,
        gross.alias("gross_order_value"),
        fee.alias("estimated_marketplace_commission"),
        recipe.alias("calculated_recipe_cogs"),
        packaging.alias("packaging_cost"),
        (gross - fee - recipe - packaging).alias("true_net_payout_margin"))


def allocated_fact(
    silver: DataFrame, cogs: DataFrame, rate: Decimal | str = COMMISSION_RATE, keep: tuple[str, ...] = (),
    place: str | None = None, staged: bool = False,
) -> DataFrame:
    """The fact with the order total and its commission split over the lines, and the units sold.

    The weight is quantity * unit price; costs are charged per unit sold.  Sums over the lines of
    an order give its total, its commission and its margin exactly.  `keep` names further line
    columns to carry along; nothing else is read.  `place` names a further column for the line's
    number in its order, by which lines that are alike but for the last cent are told apart.  With `staged` the split
    lines are written once before the costs are joined, so that less of the disk is taken at a time.
    """
    key = ["merchant_id", "order_id", "source_marketplace"]
    narrow = silver.select(
        *key, "line_item_no", "line_item_sku", "line_item_qty", "created_at", *keep, "total_amount",
        F.coalesce(F.col("line_item_qty").cast("bigint") * F.col("line_item_unit_price"), F.lit(0)).alias("_value"),
        commission("total_amount", rate).alias("_order_fee"))
    split = allocate(narrow, {"_gross": "total_amount", "_fee": "_order_fee"}, "_value", key,
                     ["line_item_no", "line_item_sku", "_value"], page="line_item_no", place=place)
    if staged:
        split = stage(split.drop("total_amount", "_order_fee", "_value"), "split-lines")
    costed = join_cogs(split, cogs)
    qty = F.col("line_item_qty").cast("bigint")
    recipe, packaging = qty * F.col("recipe_cost"), qty * F.col("packaging_cost")
    return costed.select(
        *key, "line_item_no", "line_item_sku", qty.alias("units_sold"), "created_at", *keep,
        F.col("_gross").alias("gross_order_value"),
        F.col("_fee").alias("estimated_marketplace_commission"),
        recipe.alias("calculated_recipe_cogs"),
        packaging.alias("packaging_cost"),
        (F.col("_gross") - F.col("_fee") - recipe - packaging).alias("true_net_payout_margin"), *([place] if place else []))


def enrich_fact(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows with the catalog's item name and seen range."""
    return fact.join(dim, ITEM_KEY, "left")


def recompute_affected(
    silver: DataFrame, cogs: DataFrame, changed: DataFrame, rate: Decimal | str = COMMISSION_RATE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Fact rows of every line whose (merchant, SKU) cost changed, ready to merge."""
    touched = silver.join(changed.select(*ITEM_KEY).distinct(), ITEM_KEY, "left_semi")
    return fact_financial_sales(touched, cogs, rate, keep)
