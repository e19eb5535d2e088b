"""Tables with published versions: readers, failed checks, merges that write only what changed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablemargin.operators import quality, star
from tablemargin.operators.flatten import ORDER_KEY
from tablemargin.plans.registry import query
from tablemargin.session import scratch_path
from tablemargin.sources.versioned import VersionedTable

_COLUMNS = ["order_id", "merchant_id", "source_marketplace", "total_amount"]


def _check(rows):
    return quality.run_checks(rows, "orders", quality.not_null(["order_id"])).unionByName(
        quality.check_unique(rows, "orders", ["order_id"]))


@query("""SELECT 1 AS version, order_id, merchant_id, source_marketplace, total_amount FROM hdr WHERE o_orderkey % 2 = 0
          UNION ALL SELECT 2, order_id, merchant_id, source_marketplace, total_amount + o_orderkey % 2 FROM hdr""", ("hdr",))
def published_versions(t):
    """A reader of the first version, a refresh that reads the table itself, and one whose check fails and leaves no trace."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "published"), ["order_id"], ["merchant_id"])
    orders, odd = t.headers().select(*_COLUMNS, "o_orderkey"), F.col("o_orderkey") % 2
    table.replace(orders.where(odd == 0).select(_COLUMNS), _check)
    before = table.read()
    new = orders.where(odd == 1).withColumn("total_amount", F.col("total_amount") + 1).select(_COLUMNS)
    table.replace(table.read().unionByName(new), _check)
    try:
        table.replace(table.read().unionByName(new), _check)
    except quality.QualityError:
        pass
    return before.select(F.lit(1).alias("version"), *_COLUMNS).unionByName(table.read().select(F.lit(2).alias("version"), *_COLUMNS))


@query("""SELECT order_id, merchant_id, source_marketplace, line_item_no, line_item_sku,
                 CASE WHEN o % 100 = 7 THEN gross_order_value + 1 ELSE gross_order_value END AS gross_order_value,
                 CASE WHEN o % 100 = 7 THEN 'corrected' END AS note
          FROM (SELECT *, CAST(substr(order_id, 5) AS BIGINT) AS o FROM fact) WHERE o % 100 <> 9 AND (o % 100 <> 7 OR line_item_no > 1)""", ("fact",))
def merge_on_read(t):
    """One order in a hundred corrected in two steps and shortened, one cleared: changes laid over a base that stays as it is."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "sales"), ORDER_KEY, ["merchant_id"])
    fact = star.fact_financial_sales(t.lines(), t.cogs()).select(
        "order_id", "merchant_id", "source_marketplace", "line_item_no", "line_item_sku", "gross_order_value")
    rest = F.substring("order_id", 5, 20).cast("bigint") % 100
    table.replace(fact)
    wrong = fact.where(rest == 7).withColumn("gross_order_value", F.lit(-1).cast("bigint"))
    table.upsert(wrong, clear=fact.where(rest == 9).select(*ORDER_KEY))
    right = fact.where((rest == 7) & (F.col("line_item_no") > 1)).withColumns(
        {"gross_order_value": F.col("gross_order_value") + 1, "note": F.lit("corrected")})
    # A corrected order whose only line went has no rows any more, but its key.
    table.upsert(right, clear=fact.where(rest == 7).select(*ORDER_KEY))
    return table.read()
