"""Star schema and the figures served from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemargin.operators import flatten, serving, settlement, star
from tablemargin.plans.registry import query
from tablemargin.plans.shared_tables import SALT, sql_pct
from tablemargin.session import delete_scratch, scratch_noted
from tablemargin.sources.tables import stage

TENANT = "store_007"


def fact(t):
    return star.fact_financial_sales(t.lines(), t.cogs())


@query("SELECT * FROM fact", ("fact",))
def fact_financial_sales(t):
    return fact(t)


@query("""SELECT merchant_id, line_item_sku, count(*) AS line_count, CAST(sum(coalesce(recipe_cost, 0)) AS BIGINT)
            AS recipe_cost, CAST(sum(coalesce(packaging_cost, 0)) AS BIGINT) AS packaging_cost
          FROM silver LEFT JOIN cogs USING (merchant_id, line_item_sku) GROUP BY ALL""", ("silver", "cogs"))
def join_cogs(t):
    return star.join_cogs(t.lines(), t.cogs()).groupBy("merchant_id", "line_item_sku").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("recipe_cost").alias("recipe_cost"),
        F.sum("packaging_cost").alias("packaging_cost"))


@query("SELECT * FROM alloc", ("alloc",))
def allocated_fact(t):
    return star.allocated_fact(t.lines(), t.cogs())


@query("SELECT * FROM fact JOIN dim USING (merchant_id, line_item_sku)", ("fact", "dim"))
def enrich_fact(t):
    return star.enrich_fact(fact(t), star.dim_menu_catalog(t.lines()))


@query("SELECT * FROM dim", ("dim",))
def dim_menu_catalog(t):
    return star.dim_menu_catalog(t.lines())


# Parts are renamed by channel so that a SKU has several names.
_NAMED = """(SELECT *, CASE WHEN source_marketplace = 'ubereats' THEN upper(line_item_name) ELSE line_item_name END
    AS shown FROM silver)"""


@query(f"""SELECT merchant_id, line_item_sku, line_item_name, first_seen_at, last_seen_at
           FROM (SELECT merchant_id, line_item_sku, shown AS line_item_name,
                        min(min(created_at)) OVER (PARTITION BY merchant_id, line_item_sku) AS first_seen_at,
                        max(max(created_at)) OVER (PARTITION BY merchant_id, line_item_sku) AS last_seen_at,
                        row_number() OVER (PARTITION BY merchant_id, line_item_sku ORDER BY count(*) DESC, shown) AS rn
                 FROM {_NAMED} GROUP BY merchant_id, line_item_sku, shown) WHERE rn = 1""", ("silver",))
def dim_menu_catalog_mode(t):
    shown = F.when(F.col("source_marketplace") == "ubereats", F.upper("line_item_name")).otherwise(
        F.col("line_item_name"))
    return star.dim_menu_catalog(t.lines().withColumn("line_item_name", shown), name="mode")


@query(f"SELECT line_item_sku, line_item_name FROM dim WHERE merchant_id = '{TENANT}'", ("dim",))
def list_menu_items(t):
    return serving.list_menu_items(star.dim_menu_catalog(t.lines()), merchant_id=TENANT)


@query(f"""SELECT line_item_sku, recipe_cost / 100.0 AS recipe_cost, packaging_cost / 100.0 AS packaging_cost
           FROM cogs WHERE merchant_id = '{TENANT}'""", ("cogs",))
def list_merchant_cogs(t):
    return serving.list_merchant_cogs(t.cogs_ledger(), merchant_id=TENANT)


@query(f"SELECT * FROM fact WHERE merchant_id = '{TENANT}'", ("fact",))
def tenant_fence(t):
    return serving.tenant(fact(t), merchant_id=f" {TENANT} ")


@query("""SELECT merchant_id, line_item_sku, line_item_name,
                 coalesce(CAST(recipe_cost AS DOUBLE), 0) AS recipe_cost,
                 coalesce(CAST(packaging_cost AS DOUBLE), 0) AS packaging_cost
          FROM dim LEFT JOIN cogs USING (merchant_id, line_item_sku)""", ("dim", "cogs"))
def menu_cogs_grid(t):
    return serving.menu_cogs_grid(star.dim_menu_catalog(t.lines()), t.cogs())


@query("""SELECT line_item_sku, CAST(sum(true_net_payout_margin) AS BIGINT) AS net_profit
          FROM fact GROUP BY 1""", ("fact",))
def menu_engineering(t):
    return serving.menu_engineering(fact(t))


@query(f"""SELECT *, {sql_pct('net_profit', 'gross_sales')} AS margin_pct,
                  net_profit * 100 < gross_sales * 84.5 AS below_target
           FROM (SELECT merchant_id, line_item_sku, CAST(sum(true_net_payout_margin) AS BIGINT) AS net_profit,
                        count(*) AS line_count, CAST(sum(gross_order_value) AS BIGINT) AS gross_sales,
                        CAST(sum(units_sold) AS BIGINT) AS units_sold
                 FROM alloc GROUP BY 1, 2)""", ("alloc",))
def menu_engineering_vs_target(t):
    return serving.menu_engineering(star.allocated_fact(t.lines(), t.cogs()), target_pct="84.5", by=["merchant_id"])


@query("""SELECT line_item_sku, CAST(sum(true_net_payout_margin) AS BIGINT) AS net_profit
          FROM fact GROUP BY 1 ORDER BY net_profit DESC, line_item_sku LIMIT 25""", ("fact",))
def menu_engineering_top_k(t):
    return serving.menu_engineering(fact(t), k=25)


@query("""SELECT source_marketplace, CAST(sum(gross_order_value) AS BIGINT) AS gross_sales,
                 CAST(sum(net_payout_amount) AS BIGINT) AS net_payout,
                 CAST(sum(true_net_payout_margin) AS BIGINT) AS true_profit
          FROM docsettled GROUP BY 1""", ("docsettled",))
def documents_to_leakage(t):
    """End to end: landed documents to lines, allocated sales, settled payout and profit per marketplace."""
    with scratch_noted() as used:
        t.keep_orders_with_lines()
        lines = stage(flatten.silver_orders(t.bronze_orders(), SALT), "lines")
    delete_scratch(t.spark, used[:-1])
    recon = settlement.settlement_reconciliation(flatten.order_headers(lines), t.reports())
    with scratch_noted() as split:
        fact = star.allocated_fact(lines, t.cogs(), place="_place", staged=True)
    settled = settlement.fact_with_settlement(fact, recon, place="_place")
    # The settled fact reads what it staged itself.
    delete_scratch(t.spark, [*used[-1:], *split])
    return serving.profit_leakage(settled)
