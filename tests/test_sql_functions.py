"""The SQL functions agree with the columns they stand for; the tenant functions cannot be called without a tenant."""

import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablemargin.functions import money, naming, pii, times
from tablemargin.functions.sql import RATE, register, register_tenant_table
from tablemargin.session import own_session
from tablemargin.sources.tables import write_table


@pytest.fixture()
def sql(spark):
    session = own_session(spark)
    register(session, "pepper")
    return session


def test_agree_with_the_columns(sql):
    values = [(a, b) for a in (None, -1050, -10, -1, 0, 1, 10, 30, 50, 1050, 10 ** 15) for b in (None, -5, 0, 3, 700, 10 ** 15)]
    df = sql.createDataFrame(values, "a bigint, b bigint")
    both = df.select(
        F.expr("tm_commission(a)").alias("x1"), money.commission("a").alias("y1"),
        F.expr("tm_percent(a, b)").alias("x2"), money.percent_tenths(F.col("a"), F.col("b")).alias("y2"),
        F.expr("tm_salted_hash(string(a))").alias("x3"), pii.salted_hash(F.col("a").cast("string"), "pepper").alias("y3"))
    for r in both.collect():
        assert (r.x1, r.x2, r.x3) == (r.y1, r.y2, r.y3)
    text = sql.createDataFrame([(" usd ",), ("U$D",), ("",), (None,), ("eur",)], "c string").select(
        F.expr("tm_normalize_currency(c)").alias("x"), money.normalize_currency("c").alias("y"))
    assert all(r.x == r.y for r in text.collect())


def test_names_and_days(sql):
    run = dt.datetime(2024, 11, 3, 4, 30, 9)
    df = sql.createDataFrame([("m1", dt.date(2024, 3, 5), run), ("m1", None, run), ("m1", dt.date(2024, 3, 5), None)], "m string, d date, r timestamp_ntz")
    key = F.expr("tm_bronze_key(m, 'orders', d, r)")
    got = df.select(key.alias("x"), naming.bronze_key(F.col("m"), F.lit("orders"), F.col("d"), F.col("r")).alias("y"),
                    F.expr("tm_local_date(r, 'America/New_York')").alias("dx"), times.local_date("r", "America/New_York").alias("dy")).collect()
    assert all(r.x == r.y and r.dx == r.dy for r in got) and got[0].x.endswith("/day=05/orders-20241103T043009Z.json")
    names = sql.createDataFrame([(got[0].x,), ("orders.json",), ("orders-20249903T043009Z.json",), (None,)], "f string")
    parsed = names.select(F.expr("tm_run_time(f)").alias("x"), naming.parse_bronze_filename("f").run_timestamp_utc.alias("y")).collect()
    assert [r.x for r in parsed] == [r.y for r in parsed] == [run, None, None, None]


def test_variables(sql, spark):
    sql.sql(f"SET VARIABLE {RATE} = 0.5")
    assert sql.sql("SELECT tm_commission(101)").first()[0] == 51
    register(sql, rate="0.25")
    assert sql.sql("SELECT tm_commission(102)").first()[0] == 26
    with pytest.raises(PySparkException, match="tm_pii_salt is not set"):
        sql.sql("SELECT tm_salted_hash('x')").collect()
    with pytest.raises(PySparkException):
        spark.sql("SELECT tm_commission(1)")


def test_tenant_function(sql, tmp_path):
    path = str(tmp_path / "sales")
    write_table(sql.createDataFrame([("m1", 1), ("m2", 2), ("m1", 3)], "merchant_id string, v int"), path, ["merchant_id"])
    register_tenant_table("tm_test_sales", sql.read.parquet(path))
    one = sql.sql("SELECT * FROM tm_test_sales(' m1 ')")
    assert sorted(r.v for r in one.collect()) == [1, 3]
    assert re.search(r"PartitionFilters: \[[^]]*merchant_id[^]]*m1", one._jdf.queryExecution().executedPlan().toString())
    assert sql.sql("SELECT * FROM tm_test_sales('m9')").count() == 0
    for blank in ("''", "'  '", "NULL"):
        with pytest.raises(PySparkException, match="merchant_id is required"):
            sql.sql(f"SELECT * FROM tm_test_sales({blank})").collect()
    for call in ("tm_test_sales()", "tm_test_sales"):
        with pytest.raises(PySparkException):
            sql.sql(f"SELECT * FROM {call}").collect()
