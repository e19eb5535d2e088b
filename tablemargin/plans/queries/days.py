"""Store-local windows and backfill calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablemargin.operators import calendar
from tablemargin.plans.registry import query

_NOW = dt.datetime(1998, 6, 11, 1, 0, 0)
_DAYS = 60


def _sql_start(day: str, tz: str) -> str:
    return f"(CAST({day} AS TIMESTAMP) AT TIME ZONE {tz} AT TIME ZONE 'UTC')"


@query(f"""SELECT order_id, store_tz, target_date, {_sql_start('target_date', 'store_tz')} AS window_start,
                  {_sql_start('target_date + 1', 'store_tz')} - INTERVAL 1 MICROSECOND AS window_end
           FROM (SELECT *, CAST(created_at AS DATE) AS target_date FROM hdr)""", ("hdr",))
def store_day_windows(t):
    days = t.headers().select("order_id", "store_tz", F.col("created_at").cast("date").alias("target_date"))
    return calendar.store_day_windows(days)


@query("""SELECT order_id, store_tz, created_at FROM hdr
          WHERE CAST(created_at AT TIME ZONE 'UTC' AT TIME ZONE store_tz AS DATE) = CAST(created_at AS DATE)""", ("hdr",))
def orders_in_store_day(t):
    """Orders whose UTC date is also their store's date."""
    return calendar.in_store_day(
        t.headers(), "created_at", F.col("store_tz"), F.col("created_at").cast("date")).select(
        "order_id", "store_tz", "created_at")


@query(f"""SELECT *, {_sql_start('target_date', 'store_tz')} AS window_start,
                  {_sql_start('target_date + 1', 'store_tz')} - INTERVAL 1 MICROSECOND AS window_end
           FROM (SELECT *, CAST(TIMESTAMP '{_NOW}' AT TIME ZONE 'UTC' AT TIME ZONE store_tz AS DATE) - 1 AS target_date
                 FROM stores)""", ("stores",))
def t1_windows(t):
    return calendar.t1_windows(t.stores(), _NOW)


_CALENDAR = f"""(SELECT stores.*, DATE '{_NOW.date()}' - CAST(i AS INTEGER) AS target_date
    FROM stores, (SELECT range AS i FROM range(1, {_DAYS + 1})))"""


@query(f"SELECT * FROM {_CALENDAR}", ("stores",))
def backfill_calendar(t):
    return calendar.backfill_calendar(t.stores(), _DAYS, _NOW)


@query(f"""SELECT * FROM {_CALENDAR} c WHERE NOT EXISTS (SELECT 1 FROM hdr
           WHERE 'cust_' || o_custkey = c.merchant_id AND CAST(created_at AS DATE) = c.target_date)""",
       ("stores", "hdr"))
def backfill_gaps(t):
    landed = t.headers().select(
        F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("merchant_id"),
        F.col("created_at").cast("date").alias("target_date"))
    return calendar.backfill_gaps(t.stores(), _DAYS, _NOW, landed)
