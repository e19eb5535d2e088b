"""Nested order documents to order and line rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablemargin.functions.money import tidy_currency
from tablemargin.functions.pii import salted_hash
from tablemargin.functions.times import local_date, utc_ntz
from tablemargin.operators.incremental import latest_run_wins
from tablemargin.schemas import BRONZE_ORDERS, SILVER_ORDERS
from tablemargin.sources.tables import stage

ORDERS = BRONZE_ORDERS["orders"].dataType
ITEMS = ORDERS.elementType["items"].dataType

#: What the line table makes of fields of orders and lines that its own columns do not cover.
ORDER_FIELD, LINE_FIELD = "order_", "line_item_"
ORDER_KEY = ["merchant_id", "order_id", "source_marketplace"]


def _created_at(bronze: DataFrame) -> Column:
    field = bronze.schema["orders"].dataType.elementType["created_at"].dataType
    created = F.col("o.created_at")
    return utc_ntz(created) if isinstance(field, T.TimestampType) else created


def _promoted(kind: T.DataType, known: T.DataType, of: str, prefix: str) -> list[Column]:
    """Columns of the fields that a document schema names beyond ours."""
    return [F.col(f"{of}.`{name}`").alias(prefix + name) for name in kind.elementType.names if name not in known.elementType.names]


def _is_promoted(name: str) -> bool:
    return name not in SILVER_ORDERS.names and name.startswith((ORDER_FIELD, LINE_FIELD))


def flatten_orders(bronze: DataFrame) -> DataFrame:
    """One row per order of `orders[]`, keeping `items` nested; landing columns are carried along.

    Documents with an empty or NULL `orders` disappear; a document that did not parse is one of
    these, so check it first (`quality.check_landing`).  Fields of an order that the documents'
    schema names beyond `BRONZE_ORDERS` come along as `order_...`, those of a line as `line_item_...`.
    """
    carried = [c for c in bronze.columns if c in ("path_merchant_id", "path_date", "run_timestamp_utc")]
    # The outer form, as the inner one lets the planner infer a filter on the array's size, and with it
    # a second parse of the documents below.
    exploded = bronze.select(*carried, F.posexplode_outer("orders").alias("_at", "o")).where(F.col("_at").isNotNull())
    return exploded.select(
        *carried,
        F.col("o.id").alias("order_id"),
        F.col("o.channel").alias("source_marketplace"),
        F.col("o.store_id").alias("merchant_id"),
        _created_at(bronze).alias("created_at"),
        F.col("o.total.amount").cast("bigint").alias("total_amount"),
        tidy_currency("o.total.currency").alias("total_currency"),
        F.col("o.customer.name_hash").alias("customer_name_hash"),
        F.col("o.customer.phone_hash").alias("customer_phone_hash"),
        F.col("o.items").alias("items"),
        *_promoted(bronze.schema["orders"].dataType, ORDERS, "o", ORDER_FIELD),
    )


def flatten_items(orders: DataFrame) -> DataFrame:
    """One row per line of `items[]`, numbered from 1 in document order as `line_item_no`.

    Orders without items disappear.
    """
    kept = [c for c in orders.columns if c != "items"]
    return orders.select(*kept, F.posexplode("items").alias("pos", "item")).select(
        *kept,
        (F.col("pos") + 1).alias("line_item_no"),
        F.col("item.sku").alias("line_item_sku"),
        F.col("item.name").alias("line_item_name"),
        F.col("item.qty").cast("int").alias("line_item_qty"),
        F.col("item.unit_price.amount").cast("bigint").alias("line_item_unit_price"),
        tidy_currency("item.unit_price.currency").alias("line_item_unit_currency"),
        *_promoted(orders.schema["items"].dataType, ITEMS, "item", LINE_FIELD),
    )


def with_target_date(df: DataFrame, tz: str | Column = "UTC") -> DataFrame:
    """Add the store-local order date; the default zone gives the UTC date."""
    return df.withColumn("target_date", local_date("created_at", tz))


def with_salted_customer(df: DataFrame, salt: str) -> DataFrame:
    return df.withColumns({
        "customer_name_hash_salted": salted_hash("customer_name_hash", salt),
        "customer_phone_hash_salted": salted_hash("customer_phone_hash", salt),
    })


def conform_lines(orders: DataFrame, salt: str, tz: str | Column = "UTC") -> DataFrame:
    """Flattened order rows to the conformed line table."""
    if "run_timestamp_utc" not in orders.columns:
        orders = orders.withColumn("run_timestamp_utc", F.lit(None).cast("timestamp_ntz"))
    # What belongs to the order is computed once for it, not once for each of its lines.
    lines = flatten_items(with_salted_customer(with_target_date(orders, tz), salt))
    return lines.select(
        "order_id", "source_marketplace", "merchant_id", "target_date", "run_timestamp_utc", "created_at",
        "total_amount", "total_currency",
        "line_item_no", "line_item_sku", "line_item_name", "line_item_qty",
        "line_item_unit_price", "line_item_unit_currency",
        "customer_name_hash", "customer_phone_hash",
        "customer_name_hash_salted", "customer_phone_hash_salted",
        *[c for c in lines.columns if _is_promoted(c)],
    )


def silver_orders(bronze: DataFrame, salt: str, tz: str | Column = "UTC", staged: bool = True) -> DataFrame:
    """Line table from order documents; where an order landed in several runs the latest counts.

    Picking the latest run reads the orders twice, so the parsed ones are staged as Parquet first
    and the JSON is parsed once; `staged=False` keeps the whole plan lazy.
    """
    orders = flatten_orders(bronze)
    if "run_timestamp_utc" in orders.columns:
        if staged:
            orders = stage(orders, "flat-orders")
        orders = latest_run_wins(orders, ORDER_KEY, "run_timestamp_utc")
    return conform_lines(orders, salt, tz)


def order_headers(silver: DataFrame) -> DataFrame:
    """One row per order: its first line carries every order-level column, so no shuffle is needed."""
    return silver.where(F.col("line_item_no") == 1).drop(
        *[c for c in silver.columns if c.startswith("line_item_")])
