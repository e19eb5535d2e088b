"""Flattening, conforming, hashing and incremental selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemargin.functions.money import commission as commission_of
from tablemargin.functions.money import normalize_currency as normalized
from tablemargin.functions.pii import salted_hash as hashed
from tablemargin.functions.pii import salted_hash_by_tenant as hashed_by_tenant
from tablemargin.operators import flatten, incremental, reports
from tablemargin.plans.registry import query
from tablemargin.plans.shared_tables import FIRST_RUN, SALT, SECOND_RUN, sql_fee


@query("""SELECT order_id, source_marketplace, merchant_id, created_at, total_amount + extra AS total_amount,
                 total_currency, customer_name_hash, customer_phone_hash, item_count
          FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 100 ELSE 0 END AS extra FROM dochdr
                UNION ALL SELECT *, 0 FROM dochdr WHERE o_orderkey % 3 = 0)""", ("dochdr",))
def flatten_orders(t):
    orders = flatten.flatten_orders(t.bronze_orders())
    return orders.withColumn("item_count", F.size("items")).drop(
        "items", "path_merchant_id", "path_date", "run_timestamp_utc")


@query("""SELECT order_id, source_marketplace, merchant_id, created_at, run, line_item_no, line_item_sku, line_item_name,
                 line_item_qty, line_item_unit_price, line_item_unit_currency
          FROM docline JOIN (VALUES (1), (2)) AS r(run) ON run = 1 OR o_orderkey % 3 = 0""", ("docline",))
def flatten_items(t):
    run = F.when(F.col("run_timestamp_utc") == str(FIRST_RUN), 1).otherwise(2).alias("run")
    return flatten.flatten_items(flatten.flatten_orders(t.bronze_orders())).select(run,
        "order_id", "source_marketplace", "merchant_id", "created_at", "line_item_no", "line_item_sku",
        "line_item_name", "line_item_qty", "line_item_unit_price", "line_item_unit_currency")


@query("""SELECT order_id, CAST(created_at AS DATE) AS utc_date,
                 CAST(created_at AT TIME ZONE 'UTC' AT TIME ZONE store_tz AS DATE) AS target_date FROM hdr""", ("hdr",))
def target_dates(t):
    utc = flatten.with_target_date(t.headers()).withColumnRenamed("target_date", "utc_date")
    return flatten.with_target_date(utc, F.col("store_tz")).select("order_id", "utc_date", "target_date")


@query("SELECT * FROM rep", ("rep",))
def silver_reports(t):
    return t.reports()


@query("""SELECT r.job_id, r.enqueue_status AS status, r.result_status AS r_status,
                 CASE WHEN d % 10 <> 1 THEN gross END AS gross
          FROM rep r JOIN jobs USING (job_id)""", ("rep",))
def join_reports(t):
    return reports.join_reports(t.bronze_enqueue(), t.bronze_result()).select(
        F.col("jobId").alias("job_id"), "status", "r_status",
        F.col("r_result.totals.gross_sales.amount").alias("gross"))


@query(f"""SELECT order_id, sha256('{SALT}' || customer_name_hash) AS customer_name_hash_salted,
                  sha256('{SALT}' || CASE WHEN o_orderkey % 5 <> 0 THEN customer_phone_hash END)
                    AS customer_phone_hash_salted
           FROM hdr""", ("hdr",))
def salted_hash(t):
    phone = F.when(F.col("o_orderkey") % 5 != 0, F.col("customer_phone_hash"))
    return t.headers().select(
        "order_id", hashed("customer_name_hash", SALT).alias("customer_name_hash_salted"),
        hashed(phone, SALT).alias("customer_phone_hash_salted"))


def _salts(t):
    """A salt for each customer except every tenth."""
    return t.table("customer").where(F.col("c_custkey") % 10 != 0).select(
        F.col("c_custkey").alias("o_custkey"), F.md5(F.col("c_name").cast("binary")).alias("pii_salt"))


@query("""SELECT order_id, o_custkey, sha256(md5(c_name) || customer_name_hash) AS customer_name_hash_salted
          FROM hdr JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 10 <> 0""", ("hdr",))
def salted_hash_by_tenant(t):
    orders = t.headers().select("order_id", "o_custkey", "customer_name_hash")
    return hashed_by_tenant(orders, _salts(t), ["customer_name_hash"], "o_custkey")[0].drop("customer_name_hash")


@query("SELECT order_id, o_custkey FROM hdr WHERE o_custkey % 10 = 0", ("hdr",))
def salted_hash_by_tenant_rejects(t):
    orders = t.headers().select("order_id", "o_custkey", "customer_name_hash")
    return hashed_by_tenant(orders, _salts(t), ["customer_name_hash"], "o_custkey")[1].drop("customer_name_hash")


@query(f"""SELECT order_id, {sql_fee('total_amount')} AS commission,
                  CAST(round(-total_amount * 0.125) AS BIGINT) AS refund_commission FROM hdr""", ("hdr",))
def commission(t):
    return t.headers().select(
        "order_id", commission_of("total_amount").alias("commission"),
        commission_of(-F.col("total_amount"), "0.125").alias("refund_commission"))


@query("""SELECT order_id, CASE o_custkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN NULL ELSE 'COP' END
            AS currency FROM hdr""", ("hdr",))
def normalize_currency(t):
    raw = F.element_at(F.array(F.lit(" usd"), F.lit("Eur "), F.lit("US1"), F.lit("COP")),
                       (F.col("o_custkey") % 4 + 1).cast("int"))
    return t.headers().select("order_id", normalized(raw).alias("currency"))


@query("""SELECT merchant_id, order_id, source_marketplace,
                 CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '{0}' ELSE TIMESTAMP '{1}' END AS run_timestamp_utc,
                 total_amount FROM hdr""".format(SECOND_RUN, FIRST_RUN), ("hdr",))
def latest_run_wins(t):
    twice = F.array(F.struct(F.lit(str(FIRST_RUN)).cast("timestamp_ntz").alias("run"), F.lit(100).alias("extra")),
                    F.struct(F.lit(str(SECOND_RUN)).cast("timestamp_ntz").alias("run"), F.lit(0).alias("extra")))
    once = F.array(F.struct(F.lit(str(FIRST_RUN)).cast("timestamp_ntz").alias("run"), F.lit(0).alias("extra")))
    landed = t.headers().withColumn(
        "r", F.explode(F.when(F.col("o_orderkey") % 3 == 0, twice).otherwise(once))).select(
        "merchant_id", "order_id", "source_marketplace", F.col("r.run").alias("run_timestamp_utc"),
        (F.col("total_amount") + F.col("r.extra")).alias("total_amount"))
    return incremental.latest_run_wins(landed, flatten.ORDER_KEY, "run_timestamp_utc")


@query("""SELECT coalesce(max(created_at), TIMESTAMP '1900-01-01') AS high_water_mark FROM hdr""", ("hdr",))
def high_water_mark(t):
    return incremental.high_water_mark(t.headers(), "created_at")


# What a table built up to a cut-off holds: later merchants stopped earlier.
def _held(t):
    return t.headers().where(F.col("created_at") < F.when(
        F.col("o_custkey") % 20 < 10, F.lit("2000-01-01 00:00:00")).otherwise(F.lit("1998-01-01 00:00:00"))
        .cast("timestamp_ntz"))


_HELD = """(SELECT * FROM hdr WHERE created_at <
    CASE WHEN o_custkey % 20 < 10 THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '1998-01-01' END)"""


@query(f"""SELECT order_id, merchant_id, created_at FROM hdr
           WHERE created_at > (SELECT coalesce(max(created_at), TIMESTAMP '1900-01-01') FROM {_HELD})""", ("hdr",))
def incremental_filter(t):
    return incremental.incremental_filter(t.headers(), _held(t), "created_at").select(
        "order_id", "merchant_id", "created_at")


@query(f"""SELECT order_id, merchant_id, created_at
           FROM hdr LEFT JOIN (SELECT merchant_id, max(created_at) AS m FROM {_HELD} GROUP BY 1) USING (merchant_id)
           WHERE created_at > coalesce(m, TIMESTAMP '1900-01-01')""", ("hdr",))
def incremental_filter_per_merchant(t):
    return incremental.incremental_filter(t.headers(), _held(t), "created_at", per=["merchant_id"]).select(
        "order_id", "merchant_id", "created_at")


@query("SELECT job_id, result_status FROM rep WHERE result_status IS NOT NULL", ("rep",))
def drop_null_keys(t):
    jobs = t.reports().select(F.when(F.col("result_status").isNotNull(), F.col("job_id")).alias("job_id"),
                              "result_status")
    return incremental.drop_null_keys(jobs, ["job_id"])
