"""Landing keys and the run time carried in file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The three landing endpoints, the merchant id format, the file-name time format.
ENDPOINTS = ("orders", "reports_enqueue", "reports_result")
MERCHANT_ID_PATTERN = "^[A-Za-z0-9_-]{1,64}$"
RUN_TIME_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
FILE_NAME_TIME = r"(\d{8}T\d{6}Z)"


def bronze_key(
    merchant_id: Column, endpoint: Column, target_date: Column, run_timestamp_utc: Column, prefix: str = ""
) -> Column:
    """{prefix}merchant_id=.../year=YYYY/month=MM/day=DD/{endpoint}-{YYYYMMDDTHHMMSSZ}.json

    The date is the order date; the time is the run, so a backfill of an old day keeps both.
    """
    day = target_date.cast("string")
    run = F.regexp_replace(F.substring(run_timestamp_utc.cast("timestamp_ntz").cast("string"), 1, 19), "[-:]", "")
    return F.concat(
        F.lit(prefix), F.lit("merchant_id="), merchant_id,
        F.lit("/year="), F.substring(day, 1, 4),
        F.lit("/month="), F.substring(day, 6, 2),
        F.lit("/day="), F.substring(day, 9, 2),
        F.lit("/"), endpoint, F.lit("-"), F.replace(run, F.lit(" "), F.lit("T")), F.lit("Z.json"),
    )


def parse_bronze_filename(file_name: Column | str) -> Column:
    """struct(target_date, run_timestamp_utc) read from a file name; both NULL when it has no run time."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    digits = F.regexp_extract(name, FILE_NAME_TIME, 1)
    stamp = F.concat_ws(
        "",
        F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 2), F.lit("-"), F.substring(digits, 7, 2),
        F.lit(" "),
        F.substring(digits, 10, 2), F.lit(":"), F.substring(digits, 12, 2), F.lit(":"), F.substring(digits, 14, 2),
    )
    run = stamp.try_cast("timestamp_ntz")
    return F.struct(run.cast("date").alias("target_date"), run.alias("run_timestamp_utc"))
