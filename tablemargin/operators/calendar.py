"""Store-local days, ingestion windows and backfill calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tablemargin.functions.times import day_end_utc, day_start_utc, local_date

# The allowed length of a backfill.
MIN_BACKFILL_DAYS, MAX_BACKFILL_DAYS = 1, 90


def store_day_windows(days: DataFrame, day: str = "target_date", tz: str = "store_tz") -> DataFrame:
    """First and last UTC microsecond of each store-local day, right across clock changes."""
    return days.withColumns({
        "window_start": day_start_utc(day, F.col(tz)), "window_end": day_end_utc(day, F.col(tz))})


def in_store_day(df: DataFrame, ts: str, tz: Column | str, day: Column | dt.date) -> DataFrame:
    """Rows whose UTC time falls on the store-local day (half-open at the next midnight)."""
    d = day if isinstance(day, Column) else F.lit(day)
    t = F.col(ts)
    return df.where((t >= day_start_utc(d, tz)) & (t < day_start_utc(F.date_add(d, 1), tz)))


def t1_windows(stores: DataFrame, now: Column | dt.datetime, tz: str = "store_tz") -> DataFrame:
    """Yesterday, as each store's clock sees it at the zone-less UTC time `now`."""
    at = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    return store_day_windows(
        stores.withColumn("target_date", F.date_sub(local_date(at, F.col(tz)), 1)), tz=tz)


def backfill_calendar(stores: DataFrame, days: int, now: Column | dt.datetime) -> DataFrame:
    """Each store's last `days` UTC dates before the date of `now`, one row per date, as `target_date`."""
    if not MIN_BACKFILL_DAYS <= days <= MAX_BACKFILL_DAYS:
        raise ValueError(f"days must be in [{MIN_BACKFILL_DAYS}, {MAX_BACKFILL_DAYS}], got {days}")
    today = (now if isinstance(now, Column) else F.lit(now)).cast("date")
    return stores.withColumn(
        "target_date", F.explode(F.sequence(F.date_sub(today, days), F.date_sub(today, 1))))


def backfill_gaps(stores: DataFrame, days: int, now: Column | dt.datetime, landed: DataFrame) -> DataFrame:
    """Calendar days of each store for which nothing landed (`merchant_id`, `target_date`).

    Landed rows are limited to the calendar's days and made distinct before the join, so a
    merchant-day with very many rows reaches it as one.
    """
    today = (now if isinstance(now, Column) else F.lit(now)).cast("date")
    present = landed.select("merchant_id", "target_date").where(
        F.col("target_date").between(F.date_sub(today, days), F.date_sub(today, 1))).distinct()
    return backfill_calendar(stores, days, now).join(present, ["merchant_id", "target_date"], "left_anti")
