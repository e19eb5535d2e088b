"""The shared test tables in the shapes our operators read, and the same shapes in SQL.

Everything is computed row by row from the given tables, so it grows with them.  `SQL` holds
the matching common table expressions for the reference check.
"""

from __future__ import annotations

import datetime as dt
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablemargin.functions.money import commission
from tablemargin.functions.naming import RUN_TIME_FORMAT
from tablemargin.operators.flatten import with_salted_customer
from tablemargin.schemas import BRONZE_ORDERS
from tablemargin.sources.tables import stage

MERCHANTS = 20
# Parts that a task makes cost rows of, some twenty for each.
PARTS_OF_A_TASK = 10_000
SALT = "pepper-for-tests"
FIRST_RUN = dt.datetime(2002, 1, 1, 2, 0, 0)
SECOND_RUN = dt.datetime(2002, 1, 2, 2, 0, 0)
ZONES = ("UTC", "America/New_York", "America/Bogota", "Asia/Tokyo")


def _text(c: Column) -> Column:
    return c.cast("string")


def _ntz(value: dt.datetime) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def merchant_of(key: Column) -> Column:
    return F.concat(F.lit("store_"), F.lpad(_text(key % MERCHANTS), 3, "0"))


def zone_of(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(z) for z in ZONES]), (key % len(ZONES)).cast("int") + 1)


def cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def landing_date(c: Column) -> Column:
    """First day of the four-year span: few landing directories, as each costs a test run dearly."""
    return F.make_date(F.year(c) - F.year(c) % 4, F.lit(1), F.lit(1))


def _once(method):
    """Keep a method's frame on its object, so that it is analyzed only once."""
    @wraps(method)
    def frame(self, *args):
        key = (method.__name__, *args)
        if key not in self._frames:
            self._frames[key] = method(self, *args)
        return self._frames[key]
    return frame


class SharedTables:
    """Lazy frames over one scale factor's directory; each is made once and shared."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[tuple, DataFrame] = {}

    @_once
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @_once
    def headers(self) -> DataFrame:
        """One row per order, in conformed columns plus the source keys."""
        return self._headers_of(self.table("orders"))

    def _headers_of(self, orders: DataFrame, *keep: str) -> DataFrame:
        channel = F.when(F.substring("o_orderpriority", 1, 1).isin("1", "4"), "ubereats").when(
            F.substring("o_orderpriority", 1, 1).isin("2", "5"), "doordash").otherwise("rappi")
        return orders.select(
            F.concat(F.lit("ord_"), _text(F.col("o_orderkey"))).alias("order_id"),
            channel.alias("source_marketplace"),
            merchant_of(F.col("o_custkey")).alias("merchant_id"),
            F.timestamp_add("MINUTE", (F.col("o_orderkey") % 1440).cast("int"), F.col("o_orderdate"))
            .alias("created_at"),
            cents(F.col("o_totalprice")).alias("total_amount"),
            F.lit("USD").alias("total_currency"),
            F.sha2(F.concat(F.lit("name:"), _text(F.col("o_custkey"))), 256).alias("customer_name_hash"),
            F.sha2(F.concat(F.lit("phone:"), _text(F.col("o_custkey"))), 256).alias("customer_phone_hash"),
            zone_of(F.col("o_custkey")).alias("store_tz"),
            "o_orderkey", "o_custkey", *keep,
        )

    @_once
    def lines(self) -> DataFrame:
        """Conformed order lines; `line_item_no` is the table's own line number."""
        part = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("line_item_name"),
            cents(F.col("p_retailprice")).alias("line_item_unit_price"))
        items = self.table("lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"), "l_partkey",
            F.col("l_linenumber").alias("line_item_no"),
            F.col("l_quantity").cast("int").alias("line_item_qty")).join(part, "l_partkey")
        joined = with_salted_customer(self.headers().join(items, "o_orderkey"), SALT)
        return joined.select(
            "order_id", "source_marketplace", "merchant_id",
            F.col("created_at").cast("date").alias("target_date"),
            _ntz(FIRST_RUN).alias("run_timestamp_utc"), "created_at", "total_amount", "total_currency",
            "line_item_no", F.concat(F.lit("SKU_"), _text(F.col("l_partkey"))).alias("line_item_sku"),
            "line_item_name", "line_item_qty", "line_item_unit_price",
            F.lit("USD").alias("line_item_unit_currency"),
            "customer_name_hash", "customer_phone_hash",
            "customer_name_hash_salted", "customer_phone_hash_salted", "store_tz", "o_orderkey")

    @_once
    def spread_parts(self) -> DataFrame:
        """Keys and prices of the parts, dealt to tasks by their number: the file is small, what `explode` makes of it is not."""
        parts = self.table("part").select("p_partkey", "p_retailprice")
        tasks = -(-parts.count() // PARTS_OF_A_TASK)
        return parts.repartition(tasks) if tasks > 1 else parts

    @_once
    def cogs(self) -> DataFrame:
        """Costs in minor units for nine of ten (merchant, SKU) pairs."""
        price = cents(F.col("p_retailprice"))
        return self.spread_parts().withColumn(
            "m", F.explode(F.sequence(F.lit(0), F.lit(MERCHANTS - 1)))).where(
            (F.col("p_partkey") + F.col("m")) % 10 != 0).select(
            merchant_of(F.col("m")).alias("merchant_id"),
            F.concat(F.lit("SKU_"), _text(F.col("p_partkey"))).alias("line_item_sku"),
            (F.call_function("div", price, F.lit(4)) + F.col("m")).alias("recipe_cost"),
            F.call_function("div", price, F.lit(40)).alias("packaging_cost"))

    @_once
    def cogs_ledger(self) -> DataFrame:
        """The same costs as the editable ledger holds them: major units with an edit time."""
        major = {c: (F.col(c) / F.lit(100)).cast("decimal(10,4)") for c in ("recipe_cost", "packaging_cost")}
        return self.cogs().withColumns(major).withColumn("updated_at", _ntz(FIRST_RUN))

    @_once
    def stores(self) -> DataFrame:
        """One store per customer, with its time zone."""
        return self.table("customer").select(
            F.concat(F.lit("cust_"), _text(F.col("c_custkey"))).alias("merchant_id"),
            zone_of(F.col("c_custkey")).alias("store_tz"))

    @_once
    def orders_with_lines(self) -> DataFrame:
        """The orders with what their documents' items are made of."""
        part = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), "p_name", cents(F.col("p_retailprice")).alias("price"))
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("int").alias("l_quantity")).join(part, "l_partkey")
        # What the items are made of is grouped, not the items: they are some three times as long.
        found = F.struct("l_partkey", "l_linenumber", "l_quantity", "p_name", "price")
        nested = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(found)).alias("found"))
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
        return orders.join(nested, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")

    def keep_orders_with_lines(self) -> None:
        """Compute the orders with their lines once for all documents that are made of them from now on."""
        self._frames["orders_with_lines",] = stage(self.orders_with_lines(), "orders-with-lines")

    @_once
    def order_documents(self) -> DataFrame:
        """Landed order documents: landing columns and the JSON payload.

        An order is one document, as a marketplace sends it, with all its lines and its total.  Orders
        whose key is a multiple of 3 landed twice, first with a total that is 100 too high.
        """
        items = F.transform("found", lambda s: F.struct(
            F.concat(F.lit("SKU_"), _text(s["l_partkey"])).alias("sku"), s["p_name"].alias("name"), s["l_quantity"].alias("qty"),
            F.struct(s["price"].alias("amount"), F.lit("USD").alias("currency")).alias("unit_price")))
        # The orders' columns are made after the join, as their hashes would be most of what is shuffled.
        orders = self._headers_of(self.orders_with_lines(), "found")
        twice = F.array(F.struct(_ntz(FIRST_RUN).alias("run"), F.lit(100).alias("extra")),
                        F.struct(_ntz(SECOND_RUN).alias("run"), F.lit(0).alias("extra")))
        once = F.array(F.struct(_ntz(FIRST_RUN).alias("run"), F.lit(0).alias("extra")))
        landed = orders.withColumn("r", F.explode(F.when(F.col("o_orderkey") % 3 == 0, twice).otherwise(once)))
        order = F.struct(
            F.col("order_id").alias("id"), F.col("merchant_id").alias("store_id"),
            F.col("source_marketplace").alias("channel"),
            F.concat(F.replace(_text(F.col("created_at")), F.lit(" "), F.lit("T")), F.lit("Z")).alias("created_at"),
            F.struct((F.col("total_amount") + F.col("r.extra")).alias("amount"),
                     F.col("total_currency").alias("currency")).alias("total"),
            F.coalesce(items, F.array()).alias("items"),
            F.struct(F.col("customer_name_hash").alias("name_hash"),
                     F.col("customer_phone_hash").alias("phone_hash")).alias("customer"))
        cursor = F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("after-"), "order_id"))
        return landed.select(
            "merchant_id", F.lit("orders").alias("endpoint"),
            landing_date(F.col("created_at")).alias("target_date"),
            F.col("r.run").alias("run_timestamp_utc"),
            F.to_json(F.struct(F.array(order).alias("orders"), cursor.alias("next_cursor"))).alias("payload"))

    @_once
    def bronze_orders(self) -> DataFrame:
        """The documents parsed, as `read_bronze` returns them."""
        return self.order_documents().select(
            F.col("merchant_id").alias("path_merchant_id"), F.col("target_date").alias("path_date"),
            "run_timestamp_utc", F.from_json("payload", BRONZE_ORDERS).alias("d"),
        ).select("path_merchant_id", "path_date", "run_timestamp_utc", "d.*")

    @_once
    def report_jobs(self) -> DataFrame:
        """One row per report job, flat; one job per merchant and order day with gaps and faults."""
        day = F.col("created_at").cast("date")
        daily = self.headers().groupBy("merchant_id", day.alias("order_day")).agg(
            F.sum("total_amount").alias("gross"), F.sum(commission("total_amount")).alias("fee"))
        d = F.dayofmonth("order_day")
        shift = F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(3653))).otherwise(F.array(F.lit(0))))
        daily = daily.where(d % 5 != 0).select("*", d.alias("d"), shift.alias("shift")).withColumn(
            "day", F.date_add("order_day", F.col("shift")))
        d = F.col("d")
        short = F.when(d % 7 == 0, F.call_function("div", F.col("gross"), F.lit(50))).otherwise(0)
        return daily.select(
            F.concat(F.lit("job_"), "merchant_id", F.lit("_"), F.replace(_text(F.col("day")), F.lit("-"), F.lit("")))
            .alias("job_id"),
            "merchant_id", "day", "d",
            F.timestamp_add("HOUR", F.lit(26), F.col("day").cast("timestamp_ntz")).alias("run_at"),
            F.when(d == 13, "WARN").when(d == 17, "FAILED").otherwise("READY").alias("result_status"),
            (F.col("gross") + F.when(d == 9, 100).otherwise(0)).alias("gross"),
            (F.col("gross") - F.col("fee") - short + F.when(d % 11 == 0, 300).otherwise(0)).alias("net"),
            F.when(d == 23, "EUR").otherwise("USD").alias("currency"))

    def keep_report_jobs(self) -> None:
        """Compute the report jobs once for all frames that are made of them from now on."""
        self._frames["report_jobs",] = stage(self.report_jobs(), "report-jobs")

    @_once
    def bronze_enqueue(self) -> DataFrame:
        """Report requests; on days divisible by 4 the job was requested again half an hour later."""
        jobs = self.report_jobs()
        runs = F.when(F.col("d") % 4 == 0, F.array(F.lit(0), F.lit(30))).otherwise(F.array(F.lit(0)))
        return jobs.withColumn("late", F.explode(runs)).select(
            F.col("merchant_id").alias("path_merchant_id"), F.col("day").alias("path_date"),
            F.timestamp_add("MINUTE", F.col("late"), F.col("run_at")).alias("run_timestamp_utc"),
            F.col("job_id").alias("jobId"),
            F.when(F.col("late") == 0, "QUEUED").otherwise("REQUEUED").alias("status"),
            F.when(F.col("d") % 2 == 0, F.timestamp_add("SECOND", F.lit(5), F.col("run_at"))).alias("created_at"))

    @_once
    def bronze_result(self) -> DataFrame:
        """Report results; jobs of days ending in 1 are still pending."""
        jobs = self.report_jobs().where(F.col("d") % 10 != 1)
        money = lambda c: F.struct(F.col(c).alias("amount"), F.col("currency"))
        start = F.col("day").cast("timestamp_ntz")
        return jobs.select(
            F.col("merchant_id").alias("path_merchant_id"), F.col("day").alias("path_date"),
            F.col("run_at").alias("run_timestamp_utc"), F.col("job_id").alias("jobId"),
            F.col("result_status").alias("status"),
            F.struct(
                F.col("merchant_id").alias("store_id"), start.alias("period_start"),
                F.timestamp_add("SECOND", F.lit(86399), start).alias("period_end"),
                F.struct(money("gross").alias("gross_sales"), money("net").alias("net_payout")).alias("totals"),
            ).alias("result"))

    @_once
    def reports(self) -> DataFrame:
        from tablemargin.operators.reports import silver_reports

        return silver_reports(self.bronze_enqueue(), self.bronze_result())

    @_once
    def run_events(self) -> DataFrame:
        """Pairs of events form a run; errors are failed runs, views and sign-ups started ones."""
        k = F.get_json_object("props", "$.k").cast("int")
        failed = F.col("event_type") == "error"
        status = F.when(failed, "FAILED").when(F.col("event_type").isin("purchase", "click"), "SUCCESS").otherwise(
            "STARTED")
        kind = F.when(k % 3 == 0, "Tier1AuthError").when(k % 3 == 1, "Tier2LatencyError").otherwise("ValueError")
        return self.table("events").select(
            F.concat(F.lit("run_"), _text(F.call_function("div", F.col("event_id"), F.lit(2)))).alias("run_id"),
            F.concat(F.lit("cust_"), _text(F.col("user_id"))).alias("merchant_id"),
            F.lit("bronze_ingestion").alias("pipeline_name"), status.alias("status"),
            F.col("ts").alias("event_at"), F.when(failed, kind).alias("error_class"),
            F.when(failed, F.concat(F.repeat(F.lit("x"), k * 20), _text(F.col("event_id")))).alias("error_message"))

    @_once
    def run_log(self) -> DataFrame:
        """One finished row per event, with status code and stack trace where it failed."""
        k = F.get_json_object("props", "$.k").cast("int")
        code = F.when(k % 5 == 0, 401).when(k % 5 == 1, 429).when(k % 5 == 2, 503).when(k % 5 == 3, 404)
        failed = F.col("event_type") == "error"
        return self.table("events").select(
            F.concat(F.lit("run_"), _text(F.col("event_id"))).alias("run_id"),
            F.concat(F.lit("cust_"), _text(F.col("user_id"))).alias("merchant_id"),
            F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
            F.timestamp_add("MINUTE", F.lit(-10), F.col("ts")).alias("started_at"),
            F.col("ts").alias("finished_at"),
            F.when(failed & (k % 2 == 0), "Tier1AuthError").when(failed & (k % 7 == 0), "Tier2LatencyError")
            .when(failed, "ValueError").alias("error_class"),
            F.when(failed, F.concat(F.repeat(F.lit("x"), k * 20), _text(F.col("event_id")))).alias("error_message"),
            F.when(failed, F.repeat(F.lit("at line "), k * 20)).alias("stack_trace"),
            F.when(failed, code).alias("http_status"))

    @_once
    def polls(self) -> DataFrame:
        """Fourteen poll responses per report job."""
        k = F.get_json_object("props", "$.k").cast("int")
        kind = F.col("event_type")
        status = F.when((kind == "error") & (k < 30), "FAILED").when((kind == "signup") & (k < 10), "CANCELLED").when(
            (kind == "purchase") & (k < 20), "READY").otherwise("PENDING")
        return self.table("events").select(
            F.concat(F.lit("job_"), _text(F.call_function("div", F.col("event_id"), F.lit(14)))).alias("job_id"),
            status.alias("status"), F.col("ts").alias("polled_at"))


_CHANNEL = ("CASE WHEN substr(o_orderpriority,1,1) IN ('1','4') THEN 'ubereats' "
            "WHEN substr(o_orderpriority,1,1) IN ('2','5') THEN 'doordash' ELSE 'rappi' END")


def sql_merchant(key: str) -> str:
    return f"'store_' || lpad(CAST({key} % {MERCHANTS} AS VARCHAR), 3, '0')"


def sql_zone(key: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{z}'" for i, z in enumerate(ZONES))
    return f"CASE {key} % {len(ZONES)} {whens} END"


def sql_cents(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


def sql_fee(c: str) -> str:
    return f"CAST(round({c} * 0.15) AS BIGINT)"


def sql_pct(part: str, whole: str) -> str:
    tenths = f"CAST((abs(CAST({part} AS HUGEINT)) * 2000 + {whole}) // (2 * CAST({whole} AS HUGEINT)) AS BIGINT)"
    return (f"CAST(CASE WHEN {whole} > 0 THEN (CASE WHEN {part} < 0 THEN -1 ELSE 1 END) * {tenths} / 10.0 "
            f"WHEN {whole} IS NOT NULL THEN 0.0 END AS DOUBLE)")


_ALLOC = """
        SELECT merchant_id, order_id, source_marketplace, line_item_no, line_item_sku,
               CAST(line_item_qty AS BIGINT) AS units_sold, created_at,
               gross AS gross_order_value, fee AS estimated_marketplace_commission,
               recipe AS calculated_recipe_cogs, packaging AS packaging_cost,
               gross - fee - recipe - packaging AS true_net_payout_margin
        FROM (SELECT *, CAST(amount * run // total - amount * (run - w) // total AS BIGINT) AS gross,
                     CAST(fees * run // total - fees * (run - w) // total AS BIGINT) AS fee,
                     line_item_qty * coalesce(c.recipe_cost, 0) AS recipe,
                     line_item_qty * coalesce(c.packaging_cost, 0) AS packaging
              FROM (SELECT *, CAST(line_item_qty * line_item_unit_price AS HUGEINT) AS w,
                           CAST(total_amount AS HUGEINT) AS amount,
                           CAST({fee} AS HUGEINT) AS fees,
                           sum(line_item_qty * line_item_unit_price) OVER (PARTITION BY order_id) AS total,
                           sum(line_item_qty * line_item_unit_price) OVER (PARTITION BY order_id
                             ORDER BY line_item_no, line_item_sku, line_item_qty * line_item_unit_price
                             ROWS UNBOUNDED PRECEDING) AS run
                    FROM {lines}) s LEFT JOIN cogs c USING (merchant_id, line_item_sku))"""
_RECON = """
        SELECT coalesce(s.merchant_id, p.merchant_id) AS merchant_id,
               coalesce(s.report_date, p.report_date) AS report_date,
               order_count, order_gross, order_commission, order_gross - order_commission AS expected_net,
               reported_gross, net_payout_amount,
               order_gross - order_commission - net_payout_amount AS settlement_variance_amount,
               CASE WHEN p.merchant_id IS NULL THEN 'MISSING_REPORT' WHEN s.merchant_id IS NULL THEN 'MISSING_ORDERS'
                    WHEN cur <> 'USD' THEN 'CURRENCY_MISMATCH'
                    WHEN ready < n OR net_payout_amount IS NULL THEN 'REPORT_NOT_READY'
                    WHEN order_gross <> reported_gross THEN 'GROSS_MISMATCH'
                    WHEN order_gross - order_commission > net_payout_amount THEN 'PAYOUT_SHORT'
                    WHEN order_gross - order_commission < net_payout_amount THEN 'PAYOUT_OVER' ELSE '' END
                 AS variance_reason
        FROM (SELECT merchant_id, CAST(created_at AS DATE) AS report_date, count(*) AS order_count,
                     CAST(sum(total_amount) AS BIGINT) AS order_gross,
                     CAST(sum({fee}) AS BIGINT) AS order_commission
              FROM {headers} GROUP BY 1, 2) s
        FULL JOIN (SELECT merchant_id, report_date, count(*) AS n, count_if(result_status = 'READY') AS ready,
                          CAST(sum(gross_sales_amount) AS BIGINT) AS reported_gross,
                          CAST(sum(net_payout_amount) AS BIGINT) AS net_payout_amount,
                          max(gross_sales_currency) AS cur
                   FROM rep GROUP BY 1, 2) p
          ON s.merchant_id = p.merchant_id AND s.report_date = p.report_date"""
_SETTLED = """
        SELECT merchant_id, report_date, order_id, source_marketplace, line_item_no, line_item_sku, units_sold, created_at,
               gross_order_value, estimated_marketplace_commission, calculated_recipe_cogs, packaging_cost,
               true_net_payout_margin, variance_reason,
               CAST(sign(net) * (abs(net) * run // total - abs(net) * (run - w) // total) AS BIGINT)
                 AS net_payout_amount,
               CAST(sign(var) * (abs(var) * run // total - abs(var) * (run - w) // total) AS BIGINT)
                 AS settlement_variance_amount
        FROM (SELECT f.*, CAST(f.gross_order_value AS HUGEINT) AS w, r.report_date, r.variance_reason,
                     CAST(r.net_payout_amount AS HUGEINT) AS net,
                     CAST(r.settlement_variance_amount AS HUGEINT) AS var,
                     sum(f.gross_order_value) OVER (PARTITION BY r.merchant_id, r.report_date) AS total,
                     sum(f.gross_order_value) OVER (PARTITION BY r.merchant_id, r.report_date
                       ORDER BY order_id, source_marketplace, line_item_no, line_item_sku, true_net_payout_margin
                       ROWS UNBOUNDED PRECEDING) AS run
              FROM {fact} f LEFT JOIN {recon} r
                ON f.merchant_id = r.merchant_id AND CAST(f.created_at AS DATE) = r.report_date)"""

# name -> (names it needs, SQL)
SQL: dict[str, tuple[list[str], str]] = {
    "hdr": ([], f"""
        SELECT 'ord_' || o_orderkey AS order_id, {_CHANNEL} AS source_marketplace,
               {sql_merchant('o_custkey')} AS merchant_id,
               o_orderdate + to_minutes(o_orderkey % 1440) AS created_at,
               {sql_cents('o_totalprice')} AS total_amount, 'USD' AS total_currency,
               sha256('name:' || o_custkey) AS customer_name_hash,
               sha256('phone:' || o_custkey) AS customer_phone_hash,
               {sql_zone('o_custkey')} AS store_tz, o_orderkey, o_custkey
        FROM orders"""),
    "silver": (["hdr"], f"""
        SELECT order_id, source_marketplace, merchant_id, CAST(created_at AS DATE) AS target_date,
               TIMESTAMP '{FIRST_RUN}' AS run_timestamp_utc, created_at, total_amount, total_currency,
               l_linenumber AS line_item_no, 'SKU_' || l_partkey AS line_item_sku, p_name AS line_item_name,
               CAST(l_quantity AS INTEGER) AS line_item_qty,
               {sql_cents('p_retailprice')} AS line_item_unit_price, 'USD' AS line_item_unit_currency,
               customer_name_hash, customer_phone_hash,
               sha256('{SALT}' || customer_name_hash) AS customer_name_hash_salted,
               sha256('{SALT}' || customer_phone_hash) AS customer_phone_hash_salted, store_tz, o_orderkey
        FROM hdr JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey"""),
    # The orders and the lines of the landed documents.
    "dochdr": (["hdr"], """
        SELECT hdr.*, coalesce(items, 0) AS item_count
        FROM hdr LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS INTEGER) AS items FROM lineitem GROUP BY 1)
          ON l_orderkey = o_orderkey"""),
    "docline": (["dochdr"], f"""
        SELECT h.*, CAST(row_number() OVER (PARTITION BY l_orderkey
                      ORDER BY l_partkey, l_linenumber, l_quantity) AS INTEGER) AS line_item_no,
               'SKU_' || l_partkey AS line_item_sku, p_name AS line_item_name,
               CAST(l_quantity AS INTEGER) AS line_item_qty,
               {sql_cents('p_retailprice')} AS line_item_unit_price, 'USD' AS line_item_unit_currency
        FROM dochdr h JOIN lineitem ON l_orderkey = o_orderkey
        JOIN part ON p_partkey = l_partkey"""),
    "cogs": ([], f"""
        SELECT {sql_merchant('m')} AS merchant_id, 'SKU_' || p_partkey AS line_item_sku,
               {sql_cents('p_retailprice')} // 4 + m AS recipe_cost,
               {sql_cents('p_retailprice')} // 40 AS packaging_cost
        FROM part, (SELECT range AS m FROM range({MERCHANTS})) WHERE (p_partkey + m) % 10 <> 0"""),
    "stores": ([], f"""
        SELECT 'cust_' || c_custkey AS merchant_id, {sql_zone('c_custkey')} AS store_tz FROM customer"""),
    "fact": (["silver", "cogs"], f"""
        SELECT s.merchant_id, s.order_id, s.source_marketplace, s.line_item_no, s.line_item_sku, s.created_at,
               s.total_amount AS gross_order_value, {sql_fee('s.total_amount')} AS estimated_marketplace_commission,
               coalesce(c.recipe_cost, 0) AS calculated_recipe_cogs, coalesce(c.packaging_cost, 0) AS packaging_cost,
               s.total_amount - {sql_fee('s.total_amount')} - coalesce(c.recipe_cost, 0)
                 - coalesce(c.packaging_cost, 0) AS true_net_payout_margin
        FROM silver s LEFT JOIN cogs c ON s.merchant_id = c.merchant_id AND s.line_item_sku = c.line_item_sku"""),
    "alloc": (["silver", "cogs"], _ALLOC.format(lines="silver", fee=sql_fee("total_amount"))),
    "dim": (["silver"], """
        SELECT merchant_id, line_item_sku, min(line_item_name) AS line_item_name,
               min(created_at) AS first_seen_at, max(created_at) AS last_seen_at
        FROM silver GROUP BY 1, 2"""),
    "jobs": (["hdr"], f"""
        SELECT 'job_' || merchant_id || '_' || replace(CAST(day AS VARCHAR), '-', '') AS job_id, merchant_id, day, d,
               CAST(day AS TIMESTAMP) + INTERVAL 26 HOUR AS run_at,
               CASE WHEN d = 13 THEN 'WARN' WHEN d = 17 THEN 'FAILED' ELSE 'READY' END AS result_status,
               gross + CASE WHEN d = 9 THEN 100 ELSE 0 END AS gross,
               gross - fee - CASE WHEN d % 7 = 0 THEN gross // 50 ELSE 0 END
                 + CASE WHEN d % 11 = 0 THEN 300 ELSE 0 END AS net,
               CASE WHEN d = 23 THEN 'EUR' ELSE 'USD' END AS currency
        FROM (SELECT *, order_day + CAST(shift AS INTEGER) AS day FROM (
                SELECT merchant_id, CAST(created_at AS DATE) AS order_day,
                       extract(day FROM created_at) AS d,
                       CAST(sum(total_amount) AS BIGINT) AS gross, CAST(sum({sql_fee('total_amount')}) AS BIGINT) AS fee
                FROM hdr GROUP BY ALL) JOIN (VALUES (0), (3653)) AS v(shift) ON shift = 0 OR d = 3
              WHERE d % 5 <> 0)"""),
    "rep": (["jobs"], """
        SELECT job_id, merchant_id, day AS report_date,
               CASE WHEN d % 2 = 0 THEN run_at + INTERVAL 5 SECOND ELSE run_at END AS enqueue_at,
               CASE WHEN d % 4 = 0 THEN 'REQUEUED' ELSE 'QUEUED' END AS enqueue_status,
               CASE WHEN d % 10 <> 1 THEN result_status END AS result_status,
               CASE WHEN d % 10 <> 1 THEN CAST(day AS TIMESTAMP) END AS result_period_start,
               CASE WHEN d % 10 <> 1 THEN CAST(day AS TIMESTAMP) + INTERVAL 86399 SECOND END AS result_period_end,
               CASE WHEN d % 10 <> 1 THEN gross END AS gross_sales_amount,
               CASE WHEN d % 10 <> 1 THEN currency END AS gross_sales_currency,
               CASE WHEN d % 10 <> 1 THEN net END AS net_payout_amount,
               CASE WHEN d % 10 <> 1 THEN currency END AS net_payout_currency
        FROM jobs"""),
    "recon": (["hdr", "rep"], _RECON.format(headers="hdr", fee=sql_fee("total_amount"))),
    "settled": (["alloc", "recon"], _SETTLED.format(fact="alloc", recon="recon")),
    "docfact": (["docline", "cogs"], f"""
        SELECT s.merchant_id, s.order_id, s.source_marketplace, s.line_item_no, s.line_item_sku, s.created_at,
               s.total_amount AS gross_order_value, {sql_fee('s.total_amount')} AS estimated_marketplace_commission,
               coalesce(c.recipe_cost, 0) AS calculated_recipe_cogs, coalesce(c.packaging_cost, 0) AS packaging_cost,
               s.total_amount - {sql_fee('s.total_amount')} - coalesce(c.recipe_cost, 0)
                 - coalesce(c.packaging_cost, 0) AS true_net_payout_margin
        FROM docline s LEFT JOIN cogs c ON s.merchant_id = c.merchant_id AND s.line_item_sku = c.line_item_sku"""),
    "docalloc": (["docline", "cogs"], _ALLOC.format(lines="docline", fee=sql_fee("total_amount"))),
    "docrecon": (["docline", "rep"], _RECON.format(
        headers="(SELECT * FROM docline WHERE line_item_no = 1)", fee=sql_fee("total_amount"))),
    "docsettled": (["docalloc", "docrecon"], _SETTLED.format(fact="docalloc", recon="docrecon")),
    "runevents": ([], """
        SELECT 'run_' || (event_id // 2) AS run_id, 'cust_' || user_id AS merchant_id,
               'bronze_ingestion' AS pipeline_name,
               CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type IN ('purchase', 'click') THEN 'SUCCESS'
                    ELSE 'STARTED' END AS status,
               ts AS event_at,
               CASE WHEN event_type = 'error' THEN CASE k % 3 WHEN 0 THEN 'Tier1AuthError'
                    WHEN 1 THEN 'Tier2LatencyError' ELSE 'ValueError' END END AS error_class,
               CASE WHEN event_type = 'error' THEN repeat('x', k * 20) || event_id END AS error_message
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""),
    "runs": (["runevents"], """
        SELECT a.run_id AS id, a.merchant_id, a.run_id, a.pipeline_name, coalesce(l.status, 'STARTED') AS status, started_at,
               l.event_at AS finished_at, l.error_class AS error_class, l.error_message AS error_message,
               started_at IS NULL AS is_orphan
        FROM (SELECT run_id, min(merchant_id) AS merchant_id, min(pipeline_name) AS pipeline_name,
                     min(event_at) FILTER (status = 'STARTED') AS started_at FROM runevents GROUP BY 1) a
        LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id
                     ORDER BY event_at DESC, (status = 'FAILED') DESC) AS rn
                   FROM runevents WHERE status <> 'STARTED') WHERE rn = 1) l ON a.run_id = l.run_id"""),
    "runlog": ([], """
        SELECT 'run_' || event_id AS run_id, 'cust_' || user_id AS merchant_id,
               CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               ts - INTERVAL 10 MINUTE AS started_at, ts AS finished_at,
               CASE WHEN event_type <> 'error' THEN NULL WHEN k % 2 = 0 THEN 'Tier1AuthError'
                    WHEN k % 7 = 0 THEN 'Tier2LatencyError' ELSE 'ValueError' END AS error_class,
               CASE WHEN event_type = 'error' THEN repeat('x', k * 20) || event_id END AS error_message,
               CASE WHEN event_type = 'error' THEN repeat('at line ', k * 20) END AS stack_trace,
               CASE WHEN event_type = 'error' THEN CASE k % 5 WHEN 0 THEN 401 WHEN 1 THEN 429 WHEN 2 THEN 503
                    WHEN 3 THEN 404 END END AS http_status
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""),
    "polls": ([], """
        SELECT 'job_' || (event_id // 14) AS job_id,
               CASE WHEN event_type = 'error' AND k < 30 THEN 'FAILED' WHEN event_type = 'signup' AND k < 10
                    THEN 'CANCELLED' WHEN event_type = 'purchase' AND k < 20 THEN 'READY' ELSE 'PENDING' END AS status,
               ts AS polled_at
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""),
}


def sql_with(needs: list[str], select: str) -> str:
    """`select` preceded by the named expressions and everything they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for inner in SQL[name][0]:
            visit(inner)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return select
    return "WITH " + ", ".join(f"{n} AS ({SQL[n][1]})" for n in ordered) + " " + select
