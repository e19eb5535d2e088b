import datetime as dt

import pytest

from tablemargin.operators import calendar
from tablemargin.operators.calendar import backfill_calendar, backfill_gaps, in_store_day, store_day_windows, t1_windows

U = dt.datetime
LAST = 999999


@pytest.mark.parametrize("day, tz, start, end", [
    (dt.date(2026, 6, 10), "America/New_York", U(2026, 6, 10, 4), U(2026, 6, 11, 3, 59, 59, LAST)),
    (dt.date(2026, 6, 10), "America/Argentina/Buenos_Aires", U(2026, 6, 10, 3), U(2026, 6, 11, 2, 59, 59, LAST)),
    # Clocks go back: a day of 25 hours.
    (dt.date(2026, 11, 1), "America/New_York", U(2026, 11, 1, 4), U(2026, 11, 2, 4, 59, 59, LAST)),
    # Clocks go forward: a day of 23 hours.
    (dt.date(2026, 3, 8), "America/New_York", U(2026, 3, 8, 5), U(2026, 3, 9, 3, 59, 59, LAST)),
    (dt.date(2026, 6, 10), "UTC", U(2026, 6, 10), U(2026, 6, 10, 23, 59, 59, LAST)),
    (dt.date(2026, 6, 10), "Asia/Tokyo", U(2026, 6, 9, 15), U(2026, 6, 10, 14, 59, 59, LAST)),
])
def test_store_day(spark, day, tz, start, end):
    df = spark.createDataFrame([(day, tz)], "target_date date, store_tz string")
    row = store_day_windows(df).first()
    assert (row.window_start, row.window_end) == (start, end)


def test_t1_is_yesterday_by_the_stores_clock(spark):
    stores = spark.createDataFrame([("m", "America/Bogota")], "merchant_id string, store_tz string")
    row = t1_windows(stores, U(2026, 6, 11, 1)).first()
    assert row.target_date == dt.date(2026, 6, 9)
    assert (row.window_start, row.window_end) == (U(2026, 6, 9, 5), U(2026, 6, 10, 4, 59, 59, LAST))


def test_backfill_of_thirty_days(spark):
    stores = spark.createDataFrame([("m",)], "merchant_id string")
    dates = [r.target_date for r in backfill_calendar(stores, 30, U(2026, 6, 10, 12)).collect()]
    assert dates == sorted(dates) and len(dates) == 30
    assert (dates[0], dates[-1]) == (dt.date(2026, 5, 11), dt.date(2026, 6, 9))


@pytest.mark.parametrize("days", [0, -1, 91])
def test_backfill_length_is_limited(spark, days):
    with pytest.raises(ValueError):
        backfill_calendar(spark.range(1), days, U(2026, 6, 10))
    assert (calendar.MIN_BACKFILL_DAYS, calendar.MAX_BACKFILL_DAYS) == (1, 90)


def test_gaps(spark):
    stores = spark.createDataFrame([("a",), ("b",)], "merchant_id string")
    landed = spark.createDataFrame([("a", dt.date(2026, 6, 9)), ("a", dt.date(2026, 6, 9)), ("b", dt.date(2026, 6, 8))],
                                   "merchant_id string, target_date date")
    got = {(r.merchant_id, r.target_date.day) for r in backfill_gaps(stores, 2, U(2026, 6, 10), landed).collect()}
    assert got == {("a", 8), ("b", 9)}


def test_in_store_day_is_half_open(spark):
    times = [U(2026, 6, 10, 3, 59, 59, LAST), U(2026, 6, 10, 4), U(2026, 6, 11, 3, 59, 59, LAST), U(2026, 6, 11, 4)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    kept = [r.ts for r in in_store_day(df, "ts", "America/New_York", dt.date(2026, 6, 10)).collect()]
    assert kept == times[1:3]
