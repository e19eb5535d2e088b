"""Merges, upserts, deletes, recomputation, full builds and streamed ingestion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablemargin.operators import flatten, merge, quality, star
from tablemargin.plans.build import Warehouse, build, save_costs
from tablemargin.plans.registry import query
from tablemargin.plans.shared_tables import FIRST_RUN, SALT
from tablemargin.session import scratch_path
from tablemargin.sources.bronze import read_bronze, write_bronze
from tablemargin.sources.tables import replace_table, write_table
from tablemargin.streaming.ingest import stream_bronze, stream_merge

_LINE_COLUMNS = ["order_id", "source_marketplace", "merchant_id", "created_at", "total_amount",
                 "line_item_no", "line_item_sku", "line_item_qty"]


def _lines_by_year(t):
    return t.lines().select(*_LINE_COLUMNS, "o_orderkey").withColumn("order_year", F.year("created_at"))


@query("""SELECT order_id, source_marketplace, merchant_id, created_at, total_amount, line_item_no, line_item_sku,
                 line_item_qty, CAST(extract(year FROM created_at) AS INTEGER) AS order_year FROM silver""", ("silver",))
def merge_silver_orders(t):
    """Stale and missing orders in the target, some filed under the wrong year, brought up to date."""
    path = scratch_path(t.spark, "silver-orders")
    lines, k = _lines_by_year(t), F.col("o_orderkey")
    stale = lines.where(k % 3 != 0).withColumns({
        "total_amount": F.when(k % 5 == 0, F.col("total_amount") + 100).otherwise(F.col("total_amount")),
        "order_year": F.when(k % 25 == 0, F.col("order_year") - 20).otherwise(F.col("order_year"))})
    write_table(stale.drop("o_orderkey"), path, ["source_marketplace", "order_year"])
    incoming = lines.where((k % 3 == 0) | (k % 5 == 0)).drop("o_orderkey")
    merge.merge_replace(path, incoming, flatten.ORDER_KEY, ["source_marketplace", "order_year"])
    return t.spark.read.schema(incoming.schema).parquet(path)


@query("SELECT * FROM rep", ("rep",))
def merge_silver_reports(t):
    """A job that was pending in the target has its result after the merge."""
    path = scratch_path(t.spark, "silver-reports")
    reports = t.reports()
    pending = reports.where(F.dayofmonth("report_date") % 2 == 0).withColumns({
        c: F.lit(None).cast(dict(reports.dtypes)[c]) for c in ("result_status", "gross_sales_amount")})
    write_table(pending, path, ["merchant_id"])
    merge.merge_replace(path, reports, ["job_id"], ["merchant_id"], keys_move=False)
    return t.spark.read.schema(reports.schema).parquet(path)


@query("SELECT * FROM dim", ("dim",))
def merge_dim(t):
    """The catalog of half the orders, then merged with that of all."""
    path = scratch_path(t.spark, "dim")
    lines = t.lines()
    write_table(star.dim_menu_catalog(lines.where(F.col("o_orderkey") % 2 == 0)), path, ["merchant_id"])
    dim = star.dim_menu_catalog(lines)
    merge.merge_replace(path, dim, ["merchant_id"], ["merchant_id"])
    return t.spark.read.schema(dim.schema).parquet(path)


@query("SELECT * FROM fact", ("fact",))
def merge_fact(t):
    path = scratch_path(t.spark, "fact")
    fact = star.fact_financial_sales(t.lines(), t.cogs())
    odd = F.substring("order_id", -1, 1).isin("1", "3", "5")
    held = fact.where(odd).withColumn("calculated_recipe_cogs", F.lit(0).cast("bigint"))
    write_table(held, path, ["merchant_id"])
    merge.merge_replace(path, fact, flatten.ORDER_KEY, ["merchant_id"], keys_move=False)
    return t.spark.read.schema(fact.schema).parquet(path)


@query("""SELECT order_id, merchant_id, total_amount, CASE WHEN o_orderkey % 2 = 0 THEN source_marketplace END
            AS source_marketplace FROM hdr""", ("hdr",))
def merge_with_new_column(t):
    """A merge that brings a column the target does not have yet."""
    path = scratch_path(t.spark, "evolving")
    orders, k = t.headers(), F.col("o_orderkey")
    write_table(orders.where(k % 2 == 1).select("order_id", "merchant_id", "total_amount"), path, ["merchant_id"])
    incoming = orders.where(k % 2 == 0).select("order_id", "merchant_id", "total_amount", "source_marketplace")
    merge.merge_replace(path, incoming, ["merchant_id", "order_id"], ["merchant_id"], evolve=True)
    return t.spark.read.schema(incoming.schema).parquet(path)


@query("SELECT order_id, merchant_id, total_amount FROM hdr", ("hdr",))
def full_refresh(t):
    """A table replaced by one computed from itself and the orders it lacks."""
    path = scratch_path(t.spark, "refreshed")
    orders = t.headers().select("order_id", "merchant_id", "total_amount", "o_orderkey")
    write_table(orders.where(F.col("o_orderkey") % 2 == 0).drop("o_orderkey"), path, ["merchant_id"])
    held = t.spark.read.schema("order_id string, total_amount bigint, merchant_id string").parquet(path)
    replace_table(held.unionByName(orders.where(F.col("o_orderkey") % 2 == 1).drop("o_orderkey")),
                  path, ["merchant_id"])
    return t.spark.read.schema(held.schema).parquet(path)


def _edits(t):
    """Two edits of every third ledger row, and costs for the pairs that had none."""
    part = t.spread_parts().select(F.explode(F.array(F.lit(1), F.lit(2))).alias("edit"), "p_partkey")
    rows = part.withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(19)))).where(
        (F.col("p_partkey") + F.col("m")) % 3 == 0)
    return rows.select(
        F.concat(F.lit("store_"), F.lpad(F.col("m").cast("string"), 3, "0")).alias("merchant_id"),
        F.concat(F.lit("SKU_"), F.col("p_partkey").cast("string")).alias("line_item_sku"),
        (F.col("m") + F.col("edit") / 4).cast("decimal(10,4)").alias("recipe_cost"),
        F.lit(0.5).cast("decimal(10,4)").alias("packaging_cost"),
        F.timestamp_add("HOUR", F.col("edit"), F.lit(str(FIRST_RUN)).cast("timestamp_ntz")).alias("updated_at"))


_EDITS = """(SELECT 'store_' || lpad(CAST(m AS VARCHAR), 3, '0') AS merchant_id, 'SKU_' || p_partkey AS line_item_sku,
    m + 0.5 AS recipe_cost, 0.5 AS packaging_cost, TIMESTAMP '2002-01-01 04:00:00' AS updated_at
    FROM part, (SELECT range AS m FROM range(20)) WHERE (p_partkey + m) % 3 = 0)"""


def _as_double(ledger):
    return ledger.select(
        "merchant_id", "line_item_sku", F.col("recipe_cost").cast("double").alias("recipe_cost"),
        F.col("packaging_cost").cast("double").alias("packaging_cost"), "updated_at")


@query(f"""SELECT merchant_id, line_item_sku, CAST(coalesce(e.recipe_cost, c.recipe_cost / 100.0) AS DOUBLE)
             AS recipe_cost, CAST(coalesce(e.packaging_cost, c.packaging_cost / 100.0) AS DOUBLE) AS packaging_cost,
             coalesce(e.updated_at, TIMESTAMP '{FIRST_RUN}') AS updated_at
           FROM cogs c FULL JOIN {_EDITS} e USING (merchant_id, line_item_sku)""", ("cogs",))
def cogs_upsert(t):
    return _as_double(merge.upsert_cogs(t.cogs_ledger(), _edits(t)))


@query("""SELECT merchant_id, line_item_sku, CAST(recipe_cost / 100.0 AS DOUBLE) AS recipe_cost,
                 CAST(packaging_cost / 100.0 AS DOUBLE) AS packaging_cost, TIMESTAMP '2002-01-01 02:00:00' AS updated_at
          FROM cogs JOIN part ON line_item_sku = 'SKU_' || p_partkey
          WHERE (p_partkey + CAST(right(merchant_id, 3) AS INTEGER)) % 3 <> 0""", ("cogs",))
def cogs_delete(t):
    return _as_double(merge.delete_cogs(t.cogs_ledger(), _edits(t)))


@query("""SELECT f.* REPLACE (
            CASE WHEN changed THEN 1000 ELSE calculated_recipe_cogs END AS calculated_recipe_cogs,
            CASE WHEN changed THEN true_net_payout_margin + calculated_recipe_cogs - 1000
                 ELSE true_net_payout_margin END AS true_net_payout_margin)
          FROM (SELECT *, FROM fact) f
          JOIN (SELECT 'SKU_' || p_partkey AS sku, p_partkey % 50 = 1 AS changed FROM part) ON sku = line_item_sku"""
       .replace("SELECT f.* REPLACE", "SELECT * EXCLUDE (sku, changed) REPLACE").replace("SELECT *, FROM", "SELECT * FROM"),
       ("fact",))
def cogs_recompute(t):
    """New recipe costs for some SKUs: their fact rows are recomputed and take the old ones' place."""
    lines, cogs = t.lines(), t.cogs()
    fact = star.fact_financial_sales(lines, cogs)
    edited = F.substring("line_item_sku", 5, 20).cast("bigint") % 50 == 1
    sold = lines.select("merchant_id", "line_item_sku").distinct().where(edited)
    changed = sold.join(cogs.select("merchant_id", "line_item_sku", "packaging_cost"),
                        ["merchant_id", "line_item_sku"], "left").select(
        "merchant_id", "line_item_sku", F.lit(1000).cast("bigint").alias("recipe_cost"),
        F.coalesce("packaging_cost", F.lit(0)).cast("bigint").alias("packaging_cost"))
    key = ["merchant_id", "line_item_sku"]
    updated = merge.replace_by_key(cogs.select(*key, "recipe_cost", "packaging_cost"), changed, key)
    return merge.replace_by_key(fact, star.recompute_affected(lines, updated, changed), key)


@query("SELECT * FROM docsettled", ("docsettled",))
def incremental_build(t):
    """All models built twice, the second time from all documents again plus the later runs and the reports."""
    wh = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), SALT, order_partitions=("merchant_id",))
    t.keep_orders_with_lines()
    docs = t.bronze_orders()
    build(wh, orders=docs.where(F.col("run_timestamp_utc") == str(FIRST_RUN)), cogs=t.cogs())
    build(wh, orders=docs, cogs=t.cogs(), enqueue=t.bronze_enqueue(), result=t.bronze_result())
    return wh.read("served_fact").drop("target_date", "target_month").select(
        "merchant_id", "report_date", "order_id", "source_marketplace", "line_item_no", "line_item_sku", "units_sold", "created_at",
        "gross_order_value", "estimated_marketplace_commission", "calculated_recipe_cogs", "packaging_cost",
        "true_net_payout_margin", "variance_reason", "net_payout_amount", "settlement_variance_amount")


@query("SELECT * FROM docfact", ("docfact",))
def late_and_stopped_build(t):
    """The later runs land first and their build stops after the lines; then the earlier runs arrive, in a file each."""
    root = scratch_path(t.spark, "landing")
    wh = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), SALT, order_partitions=("merchant_id",))
    t.keep_orders_with_lines()
    docs = t.order_documents()
    write_bronze(docs.where(F.col("run_timestamp_utc") != str(FIRST_RUN)), root)
    build(wh, orders=read_bronze(t.spark, root, "orders"), select=["silver_orders"])
    write_bronze(docs.where(F.col("run_timestamp_utc") == str(FIRST_RUN)), root)
    build(wh, orders=read_bronze(t.spark, root, "orders"), cogs=t.cogs(), select=["silver_orders", "fact_financial_sales"])
    return wh.read("fact_financial_sales").drop("target_date")


@query("SELECT * FROM docfact", ("docfact",))
def costs_saved_then_built(t):
    """Costs saved to the ledger hold for orders that are built afterwards; the seed is only asked where none is saved."""
    wh = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), SALT, order_partitions=("merchant_id",))
    t.keep_orders_with_lines()
    docs = t.bronze_orders()
    build(wh, orders=docs.where(F.col("run_timestamp_utc") == str(FIRST_RUN)), cogs=t.cogs().limit(0),
          select=["silver_orders", "fact_financial_sales"])
    save_costs(wh, t.cogs_ledger())
    wrong = t.cogs().withColumn("recipe_cost", F.lit(1).cast("bigint"))
    build(wh, orders=docs, cogs=wrong, select=["silver_orders", "fact_financial_sales"])
    return wh.read("fact_financial_sales").drop("target_date")


@query("""SELECT 'bronze_orders' AS table_name, 'document_parsed' AS check_name, 'error' AS severity,
                 count_if(o_orderkey % 41 = 0) + count_if(o_orderkey % 41 = 0 AND o_orderkey % 3 = 0) AS failing_rows FROM dochdr
          UNION ALL
          SELECT 'bronze_orders', 'page_complete', 'warn',
                 count_if(o_orderkey % 11 = 0 AND o_orderkey % 41 <> 0)
                 + count_if(o_orderkey % 11 = 0 AND o_orderkey % 41 <> 0 AND o_orderkey % 3 = 0) FROM dochdr""", ("dochdr",))
def landing_gate(t):
    """Landed documents, some cut off half way: the build refuses them, and these are the checks it reads."""
    root = scratch_path(t.spark, "landing")
    key = F.get_json_object("payload", "$.orders[0].id")
    cut = F.substring(key, 5, 20).cast("bigint") % 41 == 0
    half = F.expr("left(payload, length(payload) div 2)")
    t.keep_orders_with_lines()
    write_bronze(t.order_documents().withColumn("payload", F.when(cut, half).otherwise(F.col("payload"))), root)
    return quality.check_landing(read_bronze(t.spark, root, "orders"))


@query("""SELECT order_id, merchant_id, source_marketplace, total_amount, CAST(extract(year FROM created_at) AS INTEGER)
            AS order_year, CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2002-01-02 02:00:00'
            ELSE TIMESTAMP '2002-01-01 02:00:00' END AS run_timestamp_utc FROM dochdr""", ("dochdr",))
def stream_ingest(t):
    """Two rounds of landing and streaming; the later run replaces the earlier."""
    root, path, checkpoint = (scratch_path(t.spark, n) for n in ("stream-landing", "stream-table", "stream-log"))
    t.keep_orders_with_lines()
    docs = t.order_documents()

    def headers(batch):
        return flatten.flatten_orders(batch).select(
            "order_id", "merchant_id", "source_marketplace", "total_amount",
            F.year("created_at").alias("order_year"), "run_timestamp_utc")

    for run in (FIRST_RUN, FIRST_RUN + dt.timedelta(days=1)):
        write_bronze(docs.where(F.col("run_timestamp_utc") == str(run)), root)
        stream_merge(stream_bronze(t.spark, root, "orders"), path, flatten.ORDER_KEY,
                     ["source_marketplace", "order_year"], checkpoint, headers, version="run_timestamp_utc"
                     ).awaitTermination()
    return t.spark.read.schema(
        "order_id string, merchant_id string, total_amount bigint, run_timestamp_utc timestamp_ntz, "
        "source_marketplace string, order_year int").parquet(path)


@query("""SELECT order_id, merchant_id, source_marketplace, total_amount, CAST(extract(year FROM created_at) AS INTEGER)
            AS order_year, CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2002-01-02 02:00:00'
            ELSE TIMESTAMP '2002-01-01 02:00:00' END AS run_timestamp_utc FROM dochdr""", ("dochdr",))
def stream_backlog(t):
    """Both runs of an order in one micro-batch: one row, of the later run."""
    root, path, checkpoint = (scratch_path(t.spark, n) for n in ("stream-landing", "stream-table", "stream-log"))

    def headers(batch):
        return flatten.flatten_orders(batch).select(
            "order_id", "merchant_id", "source_marketplace", "total_amount",
            F.year("created_at").alias("order_year"), "run_timestamp_utc")

    t.keep_orders_with_lines()
    write_bronze(t.order_documents(), root)
    stream_merge(stream_bronze(t.spark, root, "orders"), path, flatten.ORDER_KEY, ["source_marketplace", "order_year"],
                 checkpoint, headers, version="run_timestamp_utc").awaitTermination()
    return t.spark.read.schema(
        "order_id string, merchant_id string, total_amount bigint, run_timestamp_utc timestamp_ntz, "
        "source_marketplace string, order_year int").parquet(path)
