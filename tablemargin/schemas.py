"""Explicit schemas.  Money is BIGINT minor units, times are zone-less UTC unless noted."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.StructType([
    T.StructField("amount", T.LongType()),
    T.StructField("currency", T.StringType()),
])

BRONZE_ORDERS = T.StructType([
    T.StructField("orders", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("total", MONEY),
        T.StructField("items", T.ArrayType(T.StructType([
            T.StructField("sku", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("qty", T.IntegerType()),
            T.StructField("unit_price", MONEY),
        ]))),
        T.StructField("customer", T.StructType([
            T.StructField("name_hash", T.StringType()),
            T.StructField("phone_hash", T.StringType()),
        ])),
    ]))),
    T.StructField("next_cursor", T.StringType()),
])

BRONZE_REPORTS_ENQUEUE = T.StructType([
    T.StructField("jobId", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

BRONZE_REPORTS_RESULT = T.StructType([
    T.StructField("jobId", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("result", T.StructType([
        T.StructField("store_id", T.StringType()),
        T.StructField("period_start", T.TimestampType()),
        T.StructField("period_end", T.TimestampType()),
        T.StructField("totals", T.StructType([
            T.StructField("gross_sales", MONEY),
            T.StructField("net_payout", MONEY),
        ])),
    ])),
])

ENDPOINT_SCHEMAS = {
    "orders": BRONZE_ORDERS,
    "reports_enqueue": BRONZE_REPORTS_ENQUEUE,
    "reports_result": BRONZE_REPORTS_RESULT,
}

LANDING = T.StructType([
    T.StructField("merchant_id", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("target_date", T.DateType()),
    T.StructField("run_timestamp_utc", T.TimestampNTZType()),
    T.StructField("payload", T.StringType()),
])

SILVER_ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("source_marketplace", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("target_date", T.DateType()),
    T.StructField("run_timestamp_utc", T.TimestampNTZType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("total_amount", T.LongType()),
    T.StructField("total_currency", T.StringType()),
    T.StructField("line_item_no", T.IntegerType()),
    T.StructField("line_item_sku", T.StringType()),
    T.StructField("line_item_name", T.StringType()),
    T.StructField("line_item_qty", T.IntegerType()),
    T.StructField("line_item_unit_price", T.LongType()),
    T.StructField("line_item_unit_currency", T.StringType()),
    T.StructField("customer_name_hash", T.StringType()),
    T.StructField("customer_phone_hash", T.StringType()),
    T.StructField("customer_name_hash_salted", T.StringType()),
    T.StructField("customer_phone_hash_salted", T.StringType()),
])

SILVER_REPORTS = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("report_date", T.DateType()),
    T.StructField("enqueue_at", T.TimestampNTZType()),
    T.StructField("enqueue_status", T.StringType()),
    T.StructField("result_status", T.StringType()),
    T.StructField("result_period_start", T.TimestampNTZType()),
    T.StructField("result_period_end", T.TimestampNTZType()),
    T.StructField("gross_sales_amount", T.LongType()),
    T.StructField("gross_sales_currency", T.StringType()),
    T.StructField("net_payout_amount", T.LongType()),
    T.StructField("net_payout_currency", T.StringType()),
])

# The two halves of report jobs, kept apart so that either may come first.
REPORT_REQUESTS = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("run_timestamp_utc", T.TimestampNTZType()),
    T.StructField("path_merchant_id", T.StringType()),
    T.StructField("path_date", T.DateType()),
    T.StructField("enqueue_status", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

REPORT_RESULTS = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("run_timestamp_utc", T.TimestampNTZType()),
    T.StructField("result_status", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("result_period_start", T.TimestampNTZType()),
    T.StructField("result_period_end", T.TimestampNTZType()),
    T.StructField("gross_sales_amount", T.LongType()),
    T.StructField("gross_sales_currency", T.StringType()),
    T.StructField("net_payout_amount", T.LongType()),
    T.StructField("net_payout_currency", T.StringType()),
])

DIM_MENU_CATALOG = T.StructType([
    T.StructField("merchant_id", T.StringType()),
    T.StructField("line_item_sku", T.StringType()),
    T.StructField("line_item_name", T.StringType()),
    T.StructField("first_seen_at", T.TimestampNTZType()),
    T.StructField("last_seen_at", T.TimestampNTZType()),
])

COGS_SEED = T.StructType([
    T.StructField("merchant_id", T.StringType()),
    T.StructField("line_item_sku", T.StringType()),
    T.StructField("recipe_cost", T.LongType()),
    T.StructField("packaging_cost", T.LongType()),
])

# The editable ledger holds major units (3.50), unlike the seed.
COGS_LEDGER = T.StructType([
    T.StructField("merchant_id", T.StringType()),
    T.StructField("line_item_sku", T.StringType()),
    T.StructField("recipe_cost", T.DecimalType(10, 4)),
    T.StructField("packaging_cost", T.DecimalType(10, 4)),
    T.StructField("updated_at", T.TimestampNTZType()),
])

RUN_EVENTS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_at", T.TimestampNTZType()),
    T.StructField("error_class", T.StringType()),
    T.StructField("error_message", T.StringType()),
])
