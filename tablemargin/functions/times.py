"""Zone-less UTC times and store-local days.

Columns are TIMESTAMP_NTZ holding UTC, and `convert_timezone` moves them, so results do not
depend on the session time zone and daylight-saving days come out right.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_ntz(instant: Column | str) -> Column:
    """TIMESTAMP instant as zone-less UTC."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(instant)), epoch)


def local_time(utc: Column | str, tz: Column | str = "UTC") -> Column:
    """Zone-less UTC as zone-less store-local time.  A string `tz` is a zone name."""
    zone = F.lit(tz) if isinstance(tz, str) else tz
    return F.convert_timezone(F.lit("UTC"), zone, _col(utc).cast("timestamp_ntz"))


def local_date(utc: Column | str, tz: Column | str = "UTC") -> Column:
    return local_time(utc, tz).cast("date")


def day_start_utc(day: Column | str, tz: Column | str = "UTC") -> Column:
    """UTC time at which the store-local `day` begins."""
    zone = F.lit(tz) if isinstance(tz, str) else tz
    return F.convert_timezone(zone, F.lit("UTC"), _col(day).cast("timestamp_ntz"))


def day_end_utc(day: Column | str, tz: Column | str = "UTC") -> Column:
    """UTC time of the last microsecond (23:59:59.999999) of the store-local `day`."""
    return F.timestamp_add("MICROSECOND", F.lit(-1), day_start_utc(F.date_add(_col(day), 1), tz))
