"""The library's columns as SQL functions of a session, and tenant-fenced tables as SQL table functions.

Bodies are SQL expressions, so Catalyst inlines them.  Commission rate and salt are session variables:

    register(spark, salt="...")
    SET VARIABLE tm_commission_rate = 0.25;
    SELECT tm_commission(total_amount), tm_salted_hash(customer_name_hash) FROM orders;
    SELECT * FROM tm_sales('store_001');
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tablemargin.functions.money import COMMISSION_RATE
from tablemargin.functions.naming import FILE_NAME_TIME, RUN_TIME_FORMAT

RATE, PII_SALT = "tm_commission_rate", "tm_pii_salt"

# name -> (parameters, result type, body)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "tm_commission": (
        "gross BIGINT", "BIGINT", f"CAST(round(CAST(gross AS DECIMAL(19, 0)) * {RATE}, 0) AS BIGINT)"),
    "tm_percent": (
        "part BIGINT, whole BIGINT", "DOUBLE",
        "CASE WHEN whole > 0 THEN CAST(round(CAST(part AS DECIMAL(20, 0)) * 1000 / whole, 0) AS DOUBLE) / 10D "
        "WHEN whole IS NOT NULL THEN 0D END"),
    "tm_minor_units": ("major DECIMAL(18, 4)", "BIGINT", "CAST(round(major * 100, 0) AS BIGINT)"),
    "tm_normalize_currency": (
        "code STRING", "STRING", "CASE WHEN upper(trim(code)) RLIKE '^[A-Z]{3}$' THEN upper(trim(code)) END"),
    "tm_salted_hash": (
        "value STRING", "STRING",
        f"sha2(concat(coalesce({PII_SALT}, raise_error('{PII_SALT} is not set')), value), 256)"),
    "tm_local_date": (
        "utc TIMESTAMP_NTZ, tz STRING", "DATE", "CAST(convert_timezone('UTC', tz, utc) AS DATE)"),
    "tm_bronze_key": (
        "merchant STRING, endpoint STRING, day DATE, run TIMESTAMP_NTZ", "STRING",
        "concat('merchant_id=', merchant, date_format(day, \"'/year='yyyy'/month='MM'/day='dd'/'\"), endpoint, '-', "
        f"date_format(run, \"{RUN_TIME_FORMAT}\"), '.json')"),
    "tm_run_time": (
        "file_name STRING", "TIMESTAMP_NTZ",
        f"CAST(try_to_timestamp(nullif(regexp_extract(file_name, r'{FILE_NAME_TIME}', 1), ''), \"{RUN_TIME_FORMAT}\") AS TIMESTAMP_NTZ)"),
}


def register(spark: SparkSession, salt: str | None = None, rate: Decimal | str = COMMISSION_RATE) -> None:
    """Make the variables and functions known to this session; without a salt `tm_salted_hash` fails until it is set."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {RATE} DECIMAL(10, 9) DEFAULT 0")
    spark.sql(f"SET VARIABLE {RATE} = CAST(:rate AS DECIMAL(10, 9))", {"rate": Decimal(str(rate))})
    spark.sql(f"DECLARE OR REPLACE VARIABLE {PII_SALT} STRING")
    spark.sql(f"SET VARIABLE {PII_SALT} = :salt", {"salt": salt})
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")


def register_tenant_table(name: str, rows: DataFrame) -> None:
    """`name(merchant)`: the rows of one merchant, in the session of `rows`.

    The function has no form without a merchant, and a blank or NULL one is an error, not an empty
    or a full result.  The id becomes a filter on `merchant_id`: directories of other merchants are not read.
    """
    spark, view = rows.sparkSession, f"{name}_of_all_merchants"
    rows.createOrReplaceTempView(view)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    asked = f"trim(coalesce({name}.merchant, ''))"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(merchant STRING) RETURNS TABLE({columns})
        RETURN SELECT {", ".join(f"`{c}`" for c in rows.columns)} FROM {view}
        WHERE merchant_id = CASE WHEN {asked} = '' THEN raise_error('merchant_id is required') ELSE {asked} END""")
