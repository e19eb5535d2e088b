"""The library's functions called from SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemargin.functions.sql import RATE, register, register_tenant_table
from tablemargin.operators import star
from tablemargin.plans.registry import query
from tablemargin.plans.shared_tables import SALT, sql_fee, sql_pct
from tablemargin.session import scratch_path
from tablemargin.sources.tables import read_table, write_table

_TENANT = "store_007"


@query(f"""SELECT order_id, {sql_fee('total_amount')} AS fee, sha256('{SALT}' || customer_name_hash) AS salted,
                  CASE WHEN o_orderkey % 5 <> 0 THEN 'USD' END AS currency,
                  CAST(created_at + INTERVAL (CASE store_tz WHEN 'Asia/Tokyo' THEN 9 ELSE 0 END) HOUR AS DATE) AS tokyo_or_utc,
                  {sql_pct(sql_fee('total_amount'), 'total_amount')} AS fee_pct, o_orderkey AS key_again,
                  'merchant_id=' || merchant_id || strftime(created_at, '/year=%Y/month=%m/day=%d/orders-%Y%m%dT%H%M%SZ') || '.json' AS bronze_key,
                  created_at AS run_time
           FROM hdr""", ("hdr",))
def sql_scalar_functions(t):
    """Money, hash, currency, day and key functions over all orders."""
    register(t.spark, SALT)
    k = F.col("o_orderkey")
    t.headers().withColumn("code", F.when(k % 5 == 0, "U$D").otherwise(" usd ")).withColumn(
        "zone", F.when(F.col("store_tz") == "Asia/Tokyo", "Asia/Tokyo").otherwise("UTC")).createOrReplaceTempView("order_headers")
    return t.spark.sql("""
        SELECT order_id, tm_commission(total_amount) AS fee, tm_salted_hash(customer_name_hash) AS salted,
               tm_normalize_currency(code) AS currency, tm_local_date(created_at, zone) AS tokyo_or_utc,
               tm_percent(tm_commission(total_amount), total_amount) AS fee_pct,
               tm_minor_units(CAST(o_orderkey AS DECIMAL(18, 4)) / 100) AS key_again, bronze_key,
               tm_run_time(bronze_key) AS run_time
        FROM (SELECT *, tm_bronze_key(merchant_id, 'orders', CAST(created_at AS DATE), created_at) AS bronze_key FROM order_headers)""")


@query("""SELECT source_marketplace, CAST(sum(CAST(round(total_amount * 0.27) AS BIGINT)) AS BIGINT) AS fees FROM hdr GROUP BY 1""", ("hdr",))
def sql_rate_variable(t):
    """The commission rate set as a session variable."""
    register(t.spark, SALT)
    t.spark.sql(f"SET VARIABLE {RATE} = 0.27")
    t.headers().createOrReplaceTempView("order_headers")
    return t.spark.sql("SELECT source_marketplace, sum(tm_commission(total_amount)) AS fees FROM order_headers GROUP BY 1")


@query(f"""SELECT line_item_sku, CAST(sum(true_net_payout_margin) AS BIGINT) AS net_profit,
                  CAST(sum(gross_order_value) AS BIGINT) AS gross_sales,
                  {sql_pct('CAST(sum(true_net_payout_margin) AS BIGINT)', 'CAST(sum(gross_order_value) AS BIGINT)')} AS margin_pct
           FROM fact WHERE merchant_id = '{_TENANT}' GROUP BY 1""", ("fact",))
def sql_tenant_sales(t):
    """One merchant's sales from a table kept by merchant, through the table function."""
    path, fact = scratch_path(t.spark, "sales"), star.fact_financial_sales(t.lines(), t.cogs())
    write_table(fact, path, ["merchant_id"])
    register(t.spark, SALT)
    register_tenant_table("tm_sales", read_table(t.spark, path, fact.schema))
    return t.spark.sql(f"""
        SELECT line_item_sku, sum(true_net_payout_margin) AS net_profit, sum(gross_order_value) AS gross_sales,
               tm_percent(sum(true_net_payout_margin), sum(gross_order_value)) AS margin_pct
        FROM tm_sales(' {_TENANT} ') GROUP BY 1""")
