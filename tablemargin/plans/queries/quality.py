"""Data-quality checks, over lines and reports with planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemargin.functions.pii import salted_hash
from tablemargin.operators import quality, star
from tablemargin.plans.registry import query
from tablemargin.plans.shared_tables import SALT


def _dirty(t):
    k = F.col("o_orderkey")
    total = F.col("total_amount")
    return t.lines().withColumns({
        "total_amount": F.when(k % 97 == 0, 0).when(k % 101 == 0, -5).when(k % 103 != 0, total),
        "total_currency": F.when(k % 89 == 0, "us").otherwise(F.col("total_currency")),
        "line_item_qty": F.when(k % 83 == 0, 0).otherwise(F.col("line_item_qty")),
        "customer_phone_hash_salted": F.when(k % 79 != 0, F.col("customer_phone_hash_salted")),
    })


_DIRTY = """(SELECT * REPLACE (
    CASE WHEN o_orderkey % 97 = 0 THEN 0 WHEN o_orderkey % 101 = 0 THEN -5 WHEN o_orderkey % 103 <> 0
         THEN total_amount END AS total_amount,
    CASE WHEN o_orderkey % 89 = 0 THEN 'us' ELSE total_currency END AS total_currency,
    CASE WHEN o_orderkey % 83 = 0 THEN 0 ELSE line_item_qty END AS line_item_qty,
    CASE WHEN o_orderkey % 79 <> 0 THEN customer_phone_hash_salted END AS customer_phone_hash_salted) FROM silver)"""


def _sql_results(table: str, checks: list[tuple[str, str, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{severity}' AS severity, "
        f"count_if({condition}) AS failing_rows FROM {source}" for name, severity, condition in checks)


_LINE_NULLS = ["order_id", "source_marketplace", "merchant_id", "target_date", "total_amount", "total_currency",
               "customer_name_hash_salted", "customer_phone_hash_salted"]
_LINE_CHECKS = [(f"not_null_{c}", "error", f"{c} IS NULL") for c in _LINE_NULLS] + [
    ("line_item_qty_positive", "error", "line_item_qty <= 0"),
    ("total_amount_non_negative", "error", "total_amount < 0"),
    ("total_amount_not_zero", "warn", "total_amount = 0"),
    ("currency_three_letters", "warn", "NOT regexp_matches(total_currency, '^[A-Z]{3}$')"),
    ("merchant_id_well_formed", "warn", "NOT regexp_matches(merchant_id, '^[A-Za-z0-9_-]{1,64}$')")]
_LINES_SQL = _sql_results("silver_orders", _LINE_CHECKS, "dirty") + """
    UNION ALL SELECT 'silver_orders', 'unique_order_id_source_marketplace_line_item_no', 'error', count(*) FROM
      (SELECT 1 FROM dirty GROUP BY order_id, source_marketplace, line_item_no HAVING count(*) > 1)
    UNION ALL SELECT 'silver_orders', 'unique_order_id_source_marketplace', 'error', count(*) FROM
      (SELECT 1 FROM dirty WHERE line_item_no = 1 GROUP BY order_id, source_marketplace HAVING count(*) > 1)"""


def _over_dirty(select: str) -> str:
    return f"SELECT * FROM (WITH dirty AS {_DIRTY} {select})"



@query(_over_dirty(_LINES_SQL), ("silver",))
def quality_lines(t):
    """All checks of the line table: nulls, ranges, currency and ids in one pass, and uniqueness."""
    return quality.check_silver_orders(_dirty(t))


_REPORT_CHECKS = [(f"not_null_{c}", "error", f"{c} IS NULL") for c in
                  ("job_id", "merchant_id", "report_date", "enqueue_at")] + [
    (f"not_null_{c}", "error", f"{c} IS NULL AND coalesce(result_status = 'READY', false)") for c in
    ("result_status", "gross_sales_amount", "net_payout_amount")] + [
    ("no_warn_status", "warn", "result_status = 'WARN'")]


@query(_sql_results("silver_reports", _REPORT_CHECKS, "rep")
       + """ UNION ALL SELECT 'silver_reports', 'unique_job_id', 'error', count(*) FROM
             (SELECT job_id FROM rep GROUP BY 1 HAVING count(*) > 1)""", ("rep",))
def quality_reports(t):
    return quality.check_silver_reports(t.reports())


@query(_sql_results("dim_menu_catalog", [(f"not_null_{c}", "error", f"{c} IS NULL")
                                         for c in ("merchant_id", "line_item_sku")], "dim")
       + """ UNION ALL SELECT 'dim_menu_catalog', 'unique_merchant_id_line_item_sku', 'error', count(*) FROM
             (SELECT 1 FROM dim GROUP BY merchant_id, line_item_sku HAVING count(*) > 1) UNION ALL """
       + _sql_results("fact_financial_sales", [
           (f"not_null_{c}", "error", f"{c} IS NULL") for c in
           ("merchant_id", "order_id", "source_marketplace", "line_item_sku")], "fact") + " UNION ALL "
       + _sql_results("merchant_cogs", [(f"not_null_{c}", "error", f"{c} IS NULL")
                                        for c in ("merchant_id", "line_item_sku")], "cogs")
       + """ UNION ALL SELECT 'merchant_cogs', 'unique_merchant_id_line_item_sku', 'error', count(*) FROM
             (SELECT 1 FROM cogs GROUP BY merchant_id, line_item_sku HAVING count(*) > 1)""", ("dim", "fact", "cogs"))
def quality_star(t):
    lines, cogs = t.lines(), t.cogs()
    return quality.check_dim(star.dim_menu_catalog(lines)).unionByName(
        quality.check_fact(star.fact_financial_sales(lines, cogs))).unionByName(quality.check_cogs(cogs))


@query(_over_dirty(f"""SELECT count_if(failing_rows > 0 AND severity = 'error') AS failed_errors,
          count_if(failing_rows > 0 AND severity = 'warn') AS failed_warnings, count(*) AS checks_run,
          count_if(failing_rows > 0 AND severity = 'error') = 0 AS publish FROM ({_LINES_SQL})"""), ("silver",))
def quality_gate(t):
    return quality.gate(quality_lines(t))


@query("""SELECT order_id, source_marketplace, line_item_no, count(*) AS duplicate_count FROM silver
          GROUP BY 1, 2, 3 HAVING count(*) > 1""", ("silver",))
def duplicate_groups(t):
    return quality.duplicate_groups(t.lines(), ["order_id", "source_marketplace", "line_item_no"])


@query("""SELECT order_id, source_marketplace, merchant_id, created_at FROM silver
          QUALIFY count(*) OVER (PARTITION BY order_id, source_marketplace) > 1""", ("silver",))
def duplicate_rows(t):
    return quality.duplicate_rows(t.lines(), ["order_id", "source_marketplace"],
                                  ["order_id", "source_marketplace", "merchant_id", "created_at"])


@query("""SELECT 'orders' AS table_name, 'unique_order_id_source_marketplace' AS check_name, 'error' AS severity,
                 count(*) AS failing_rows
          FROM (SELECT 1 FROM hdr GROUP BY order_id, source_marketplace HAVING count(*) > 1)""", ("hdr",))
def unique_order_headers(t):
    return quality.check_unique(t.headers(), "orders", ["order_id", "source_marketplace"])


@query(_over_dirty("""SELECT order_id, source_marketplace, merchant_id, total_amount, total_currency, created_at
          FROM dirty WHERE total_amount = 0"""), ("silver",))
def zero_total_rows(t):
    check = quality.expect("total_amount_not_zero", "total_amount <> 0", "warn")
    return quality.failing_rows(_dirty(t), check).select(
        "order_id", "source_marketplace", "merchant_id", "total_amount", "total_currency", "created_at")


_NULLED = """(SELECT order_id, CASE WHEN o_orderkey % 103 <> 0 THEN total_amount END AS total_amount,
    CASE WHEN o_orderkey % 107 <> 0 THEN total_amount - 1 END AS net_amount FROM hdr)"""


def _nulled(t):
    k = F.col("o_orderkey")
    return t.headers().select(
        "order_id", F.when(k % 103 != 0, F.col("total_amount")).alias("total_amount"),
        F.when(k % 107 != 0, F.col("total_amount") - 1).alias("net_amount"))


@query(f"""SELECT order_id, coalesce(total_amount, 0) AS total_amount, coalesce(net_amount, 0) AS net_amount,
                  total_amount IS NULL OR net_amount IS NULL AS is_anomaly FROM {_NULLED}""", ("hdr",))
def quarantine_nulls(t):
    return quality.quarantine_nulls(_nulled(t), ["total_amount", "net_amount"])[0]


@query(f"""SELECT order_id, CASE WHEN total_amount IS NULL THEN 'total' ELSE 'net' END AS missing
           FROM {_NULLED} WHERE total_amount IS NULL OR net_amount IS NULL""", ("hdr",))
def quarantine_anomalies(t):
    return quality.quarantine_nulls(_nulled(t), ["total_amount", "net_amount"])[1].select(
        "order_id", F.when(F.col("total_amount").isNull(), "total").otherwise("net").alias("missing"))


@query(f"""SELECT order_id, sha256('{SALT}' || CASE WHEN o_orderkey % 13 = 0 THEN 'changed' ELSE customer_name_hash END)
             AS customer_name_hash_salted FROM hdr WHERE o_orderkey % 13 = 0""", ("hdr",))
def hash_stable(t):
    """Hashes that differ between two builds, one of which altered some customers."""
    old = t.headers().select("order_id", salted_hash("customer_name_hash", SALT).alias("customer_name_hash_salted"))
    name = F.when(F.col("o_orderkey") % 13 == 0, "changed").otherwise(F.col("customer_name_hash"))
    new = t.headers().select("order_id", salted_hash(name, SALT).alias("customer_name_hash_salted"))
    return quality.hash_stable(old, new, ["order_id"], ["customer_name_hash_salted"]).drop("old_customer_name_hash_salted")


@query("""SELECT 'bronze_orders' AS table_name, 'path_merchant_is_payload_merchant' AS check_name, 'warn' AS severity,
                 count_if(o_orderkey % 31 = 0 AND merchant_id <> 'store_999') AS failing_rows FROM hdr""", ("hdr",))
def tenant_isolation(t):
    landed = t.headers().withColumn(
        "path_merchant_id", F.when(F.col("o_orderkey") % 31 == 0, "store_999").otherwise(F.col("merchant_id")))
    return quality.run_checks(landed, "bronze_orders", [quality.tenant_isolation()])


@query("""SELECT 'bronze_orders' AS table_name, 'page_complete' AS check_name, 'warn' AS severity,
                 count(*) AS failing_rows
          FROM (SELECT * FROM dochdr UNION ALL SELECT * FROM dochdr WHERE o_orderkey % 3 = 0)
          WHERE o_orderkey % 11 = 0""", ("dochdr",))
def page_complete(t):
    return quality.run_checks(t.bronze_orders(), "bronze_orders", [quality.page_complete()])
