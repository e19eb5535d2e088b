"""Sample documents with known outcomes.  Fixed values."""

import datetime as dt
import json

ORDERS_PAGE = {
    "source": "fixture", "version": "1", "endpoint": "/v1/orders",
    "orders": [
        {"id": "ord_001", "store_id": "store_001", "channel": "ubereats", "created_at": "2026-06-10T12:00:00Z",
         "total": {"amount": 2500, "currency": "USD"},
         "items": [{"sku": "BURGER_CLASSIC", "name": "Classic Burger", "qty": 1,
                    "unit_price": {"amount": 1200, "currency": "USD"}}],
         "customer": {"name_hash": "n1", "phone_hash": "p1"}},
        {"id": "ord_002", "store_id": "store_001", "channel": "doordash", "created_at": "2026-06-10T13:00:00Z",
         "total": {"amount": 1800, "currency": "USD"},
         "items": [{"sku": "FRIES_MEDIUM", "name": "Medium Fries", "qty": 2,
                    "unit_price": {"amount": 400, "currency": "USD"}}],
         "customer": {"name_hash": "n2", "phone_hash": "p2"}},
    ],
    "next_cursor": None,
}
ENQUEUE = {"jobId": "job_abc123", "status": "QUEUED"}
RESULT = {
    "jobId": "job_abc123", "status": "READY",
    "result": {"store_id": "store_001", "period_start": "2026-06-09T00:00:00Z",
               "period_end": "2026-06-09T23:59:59Z",
               "totals": {"gross_sales": {"amount": 12500, "currency": "USD"},
                          "net_payout": {"amount": 8750, "currency": "USD"}}},
}
COGS_CSV = """merchant_id,line_item_sku,recipe_cost,packaging_cost
store_001,BURGER_CLASSIC,800,100
store_001,FRIES_MEDIUM,300,50
store_001,COLA_LARGE,150,30
store_001,SALAD_CAESAR,600,80
store_002,BURGER_CLASSIC,850,110
store_002,FRIES_LARGE,350,55
"""
SERVED_FACT = [
    ("store_001", "ORD-001", "UberEats", "BURGER", 25, 20, 15, 5, 0.0, None),
    ("store_001", "ORD-002", "DoorDash", "FRIES", 15, 12, 9, 3, 1.5, "Fee mismatch"),
    ("store_001", "ORD-003", "UberEats", "COLA", 10, 7, 5, 2, 0.0, None),
    ("store_001", "ORD-004", "DoorDash", "BURGER", 30, 24, 18, 6, 2.0, "Commission overcharge"),
    ("store_001", "ORD-005", "UberEats", "FRIES", 12, 10, 7, 3, 0.0, None),
    ("store_002", "ORD-006", "UberEats", "PIZZA", 40, 32, 28, 8, 4.0, "Wrong fee tier"),
    ("store_002", "ORD-007", "DoorDash", "SALAD", 18, 15, 12, 4, 0.0, None),
]
SERVED_SCHEMA = ("merchant_id string, order_id string, source_marketplace string, line_item_sku string, "
                 "gross_order_value bigint, net_payout_amount bigint, true_net_payout_margin bigint, "
                 "estimated_marketplace_commission bigint, settlement_variance_amount double, variance_reason string")
RUN = dt.datetime(2026, 6, 11, 2, 0, 0)


def order(order_id, items, *, store="store_001", channel="ubereats", at="2026-06-10T12:00:00Z", total=1000,
          currency="USD", name="n", phone="p"):
    """An order document; `items` are (sku, qty, unit price) triples, or None."""
    return {
        "id": order_id, "store_id": store, "channel": channel, "created_at": at,
        "total": {"amount": total, "currency": currency},
        "items": None if items is None else [
            {"sku": s, "name": s.title(), "qty": q, "unit_price": {"amount": p, "currency": currency}}
            for s, q, p in items],
        "customer": {"name_hash": name, "phone_hash": phone},
    }


def landing_row(orders, run=RUN, merchant="store_001", day=dt.date(2026, 6, 10), cursor=None):
    return (merchant, "orders", day, run, json.dumps({"orders": orders, "next_cursor": cursor}))


def landing(spark, rows):
    from tablemargin.schemas import LANDING

    return spark.createDataFrame(rows, LANDING)


def bronze(spark, rows):
    """Landing rows parsed without going through files."""
    from pyspark.sql import functions as F

    from tablemargin.schemas import BRONZE_ORDERS

    return landing(spark, rows).select(
        F.col("merchant_id").alias("path_merchant_id"), F.col("target_date").alias("path_date"),
        "run_timestamp_utc", F.from_json("payload", BRONZE_ORDERS).alias("d"),
    ).select("path_merchant_id", "path_date", "run_timestamp_utc", "d.*")


def write_file(root, endpoint, document, merchant="store_001", day=dt.date(2026, 6, 10), run="20260610T120000Z"):
    folder = root / f"merchant_id={merchant}" / f"year={day:%Y}" / f"month={day:%m}" / f"day={day:%d}"
    folder.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=2)
    (folder / f"{endpoint}-{run}.json").write_text(text)


def records(df, *order):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
