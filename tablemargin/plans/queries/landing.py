"""Landing zone queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablemargin.functions.naming import bronze_key as bronze_key_of
from tablemargin.functions.naming import parse_bronze_filename as parse_name
from tablemargin.operators.flatten import ORDER_KEY, flatten_items, flatten_orders, silver_orders
from tablemargin.operators.incremental import latest_run_wins
from tablemargin.operators.reports import silver_reports
from tablemargin.plans.registry import query
from tablemargin.plans.shared_tables import FIRST_RUN, SALT, SECOND_RUN, landing_date
from tablemargin.session import scratch_path, scratch_scope
from tablemargin.sources import bronze as bronze_source
from tablemargin.sources.bronze import incomplete_pages, read_bronze, validate_landing, write_bronze, write_report_pair
from tablemargin.sources.cogs import cogs_in_minor_units, read_cogs_seed
from tablemargin.sources.tables import read_table, write_table

_TODAY = dt.date(2001, 6, 1)


def _landing_rows(t):
    """Order-derived landing rows, some of them faulty."""
    k = F.col("o_orderkey")
    return t.headers().select(
        F.when(k % 17 == 0, F.concat(F.col("merchant_id"), F.lit("!"))).when(k % 19 == 0, "")
        .otherwise(F.col("merchant_id")).alias("merchant_id"),
        F.when(k % 23 == 0, "refunds").otherwise("orders").alias("endpoint"),
        F.when(k % 29 != 0, F.col("created_at").cast("date")).alias("target_date"),
        "order_id")


_LANDING_SQL = """(SELECT CASE WHEN o_orderkey % 17 = 0 THEN merchant_id || '!' WHEN o_orderkey % 19 = 0 THEN ''
        ELSE merchant_id END AS merchant_id,
    CASE WHEN o_orderkey % 23 = 0 THEN 'refunds' ELSE 'orders' END AS endpoint,
    CASE WHEN o_orderkey % 29 <> 0 THEN CAST(created_at AS DATE) END AS target_date, order_id FROM hdr)"""
_REASON = """CASE WHEN NOT regexp_matches(merchant_id, '^[A-Za-z0-9_-]{1,64}$') THEN 'BAD_MERCHANT_ID'
    WHEN endpoint NOT IN ('orders', 'reports_enqueue', 'reports_result') THEN 'BAD_ENDPOINT'
    WHEN target_date IS NULL THEN 'BAD_TARGET_DATE' END"""


@query(f"""SELECT *, target_date > DATE '{_TODAY}' + 1 AS far_future FROM {_LANDING_SQL}
           WHERE {_REASON} IS NULL""", ("hdr",))
def validate_landing_accepted(t):
    return validate_landing(_landing_rows(t), _TODAY)[0]


@query(f"SELECT * FROM (SELECT *, {_REASON} AS reject_reason FROM {_LANDING_SQL}) WHERE reject_reason IS NOT NULL",
       ("hdr",))
def validate_landing_rejects(t):
    return validate_landing(_landing_rows(t), _TODAY)[1]


@query("""SELECT order_id, 'landing/merchant_id=' || merchant_id || '/year=' || strftime(created_at, '%Y') || '/month='
            || strftime(created_at, '%m') || '/day=' || strftime(created_at, '%d') || '/orders-'
            || strftime(created_at + INTERVAL 26 HOUR, '%Y%m%dT%H%M%SZ') || '.json' AS bronze_key FROM hdr""", ("hdr",))
def bronze_key(t):
    run = F.timestamp_add("HOUR", F.lit(26), F.col("created_at"))
    return t.headers().select("order_id", bronze_key_of(
        F.col("merchant_id"), F.lit("orders"), F.col("created_at").cast("date"), run, "landing/").alias("bronze_key"))


@query("""SELECT order_id, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(created_at + INTERVAL 26 HOUR AS DATE) END
                 AS target_date,
                 CASE WHEN o_orderkey % 7 <> 0 THEN created_at + INTERVAL 26 HOUR END AS run_timestamp_utc
          FROM hdr""", ("hdr",))
def parse_bronze_filename(t):
    run = F.timestamp_add("HOUR", F.lit(26), F.col("created_at"))
    key = bronze_key_of(F.col("merchant_id"), F.lit("orders"), F.col("created_at").cast("date"), run)
    name = F.when(F.col("o_orderkey") % 7 == 0, "orders-undated.json").otherwise(F.element_at(F.split(key, "/"), -1))
    return t.headers().select("order_id", parse_name(name).alias("n")).select("order_id", "n.*")


@query("""SELECT merchant_id AS path_merchant_id, make_date(CAST(extract(year FROM created_at) - extract(year FROM created_at) % 4 AS INTEGER), 1, 1) AS path_date,
                 order_id, total_amount, line_item_no, line_item_sku, line_item_qty,
                 CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '{0}' ELSE TIMESTAMP '{1}' END AS run_timestamp_utc
          FROM docline""".format(SECOND_RUN, FIRST_RUN), ("docline",))
def landing_round_trip(t):
    """Documents written to the landing zone, read back and conformed."""
    root = scratch_path(t.spark, "landing")
    with scratch_scope(t.spark):
        t.keep_orders_with_lines()
        write_bronze(t.order_documents(), root)
    landed = read_bronze(t.spark, root, "orders")
    orders = latest_run_wins(flatten_orders(landed), ORDER_KEY, "run_timestamp_utc")
    return flatten_items(orders).select(
        "path_merchant_id", "path_date", "order_id", "total_amount", "line_item_no", "line_item_sku",
        "line_item_qty", "run_timestamp_utc")


@query("""SELECT job_id, merchant_id, CASE WHEN d % 10 <> 1 THEN day
                   ELSE make_date(CAST(extract(year FROM day) - extract(year FROM day) % 4 AS INTEGER), 1, 1) END AS report_date,
                 CASE WHEN d % 10 <> 1 THEN result_status ELSE 'PENDING' END AS result_status,
                 CASE WHEN d % 10 <> 1 THEN gross END AS gross_sales_amount,
                 CASE WHEN d % 10 <> 1 THEN net END AS net_payout_amount
          FROM jobs""", ("jobs",))
def report_pair_round_trip(t):
    """Requests and results landed together, read back and joined; a pending job's result holds no figures yet."""
    t.keep_report_jobs()
    root = scratch_path(t.spark, "report-pairs")
    iso = lambda c: F.concat(F.replace(c.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    money = lambda c: F.struct(F.col(c).alias("amount"), F.col("currency"))
    start = F.col("day").cast("timestamp_ntz")
    ready = F.col("d") % 10 != 1
    jobs = t.report_jobs().select(
        "merchant_id", landing_date(F.col("day")).alias("target_date"),
        F.lit(str(FIRST_RUN)).cast("timestamp_ntz").alias("run_timestamp_utc"),
        F.to_json(F.struct(F.col("job_id").alias("jobId"))).alias("request_payload"),
        F.to_json(F.struct(
            F.col("job_id").alias("jobId"), F.when(ready, F.col("result_status")).otherwise("PENDING").alias("status"),
            F.when(ready, F.struct(F.col("merchant_id").alias("store_id"), iso(start).alias("period_start"),
                     iso(F.timestamp_add("SECOND", F.lit(86399), start)).alias("period_end"),
                     F.struct(money("gross").alias("gross_sales"), money("net").alias("net_payout"))
                     .alias("totals"))).alias("result"))).alias("result_payload"))
    write_report_pair(jobs, root)
    reports = silver_reports(
        read_bronze(t.spark, root, "reports_enqueue"), read_bronze(t.spark, root, "reports_result"))
    return reports.select(
        "job_id", "merchant_id", "report_date", "result_status", "gross_sales_amount", "net_payout_amount")


@query("SELECT order_id FROM dochdr WHERE o_orderkey % 11 = 0", ("dochdr",))
def incomplete_order_pages(t):
    return incomplete_pages(t.bronze_orders()).select(F.explode("orders").alias("o")).select(
        F.col("o.id").alias("order_id")).distinct()


@query("SELECT order_id, total_amount FROM hdr", ("hdr",))
def strip_provenance(t):
    tagged = t.headers().select("order_id", "total_amount").withColumns({
        "source": F.lit("fixture"), "version": F.lit("1"), "endpoint": F.lit("/v1/orders")})
    return bronze_source.strip_provenance(tagged)


@query("SELECT *, CAST(extract(year FROM created_at) AS INTEGER) AS order_year FROM hdr", ("hdr",))
def materialized_table(t):
    """Written as partitioned Parquet and read back."""
    path = scratch_path(t.spark, "headers")
    held = t.headers().withColumn("order_year", F.year("created_at"))
    write_table(held, path, ["merchant_id", "order_year"])
    return read_table(t.spark, path, held.schema)


@query("""SELECT 'store_' || lpad(CAST(o_custkey % 20 AS VARCHAR), 3, '0') AS path_merchant_id, order_id, total_amount + extra AS total_amount, run
          FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 100 ELSE 0 END AS extra, 1 AS run FROM dochdr
                UNION ALL SELECT *, 0, 2 FROM dochdr WHERE o_orderkey % 3 = 0)""", ("dochdr",))
def landing_as_table(t):
    """Documents kept in a catalog table of their own and read by name."""
    t.bronze_orders().write.mode("overwrite").option("path", scratch_path(t.spark, "landed-documents")).saveAsTable(
        "landed_order_documents")
    run = F.when(F.col("run_timestamp_utc") == str(FIRST_RUN), 1).otherwise(2).alias("run")
    read = read_bronze(t.spark, "landed_order_documents", "orders", "table")
    return flatten_orders(read).select("path_merchant_id", "order_id", "total_amount", run)


@query("SELECT * FROM cogs", ("cogs",))
def cogs_seed(t):
    """Costs written as CSV with a header and read with the seed's schema."""
    path = scratch_path(t.spark, "cogs-seed")
    t.cogs().write.option("header", True).csv(path)
    return read_cogs_seed(t.spark, path)


@query("""SELECT order_id, source_marketplace, merchant_id, CAST(created_at AS DATE) AS target_date,
                 CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '{0}' ELSE TIMESTAMP '{1}' END AS run_timestamp_utc,
                 created_at, total_amount, total_currency, line_item_no, line_item_sku, line_item_name, line_item_qty,
                 line_item_unit_price, line_item_unit_currency, customer_name_hash, customer_phone_hash,
                 sha256('{2}' || customer_name_hash) AS customer_name_hash_salted,
                 sha256('{2}' || customer_phone_hash) AS customer_phone_hash_salted
          FROM docline""".format(SECOND_RUN, FIRST_RUN, SALT), ("docline",))
def silver_orders_table(t):
    return silver_orders(t.bronze_orders(), SALT)


@query("SELECT merchant_id, line_item_sku, recipe_cost, packaging_cost FROM cogs", ("cogs",))
def cogs_ledger_in_minor_units(t):
    return cogs_in_minor_units(t.cogs_ledger())


