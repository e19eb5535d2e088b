"""Parts sum to the amount, whatever the size of the group and however it is cut."""

import datetime as dt
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tablemargin.operators import allocate as allocation
from tablemargin.operators import settlement, star
from tablemargin.operators.allocate import allocate
from tablemargin.sources.tables import stage

SCHEMA = "g string, line int, weight bigint, amount bigint"


def brute_force(rows):
    """Running floors over a list of (line, weight, amount) in line order."""
    total = sum(max(w or 0, 0) for _, w, _ in rows)
    weights = [max(w or 0, 0) if total else 1 for _, w, _ in rows]
    total = total or len(rows)
    out, run = [], 0
    for (line, _, amount), w in zip(rows, weights):
        size, sign = abs(amount), -1 if amount < 0 else 1
        upto, below = Fraction(size * (run + w), total), Fraction(size * run, total)
        run += w
        out.append((line, sign * (upto.__floor__() - below.__floor__())))
    return out


def shares(spark, rows):
    return allocate(spark.createDataFrame(rows, SCHEMA), {"share": "amount"}, "weight", ["g"], ["line"]).collect()


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for g in range(30):
        amount = rng.choice([0, 1, -7, 100, 99999, -123456, 10**15])
        rows += [(f"g{g}", i, rng.choice([0, 0, 1, 5, 333, 10**12, -4, None]), amount)
                 for i in range(rng.randint(1, 12))]
    got = {(r.g, r.line): r.share for r in shares(spark, rows)}
    for g in {r[0] for r in rows}:
        mine = sorted((r[1], r[2], r[3]) for r in rows if r[0] == g)
        assert [(line, got[g, line]) for line, _, _ in mine] == brute_force(mine)


def test_a_group_over_many_partitions_is_split_as_in_one_window(spark):
    rng = random.Random(9)
    rows = [("hot", i, rng.randint(0, 1000), 987654321) for i in range(5000)]
    rows += [("hot and even", i, 0, 1001) for i in range(500)] + [(None, i, rng.randint(0, 3), 90) for i in range(300)]
    rows += [(f"cold{g}", i, rng.randint(0, 9), -50) for g in range(50) for i in range(3)]
    rng.shuffle(rows)
    got = {(r.g, r.line): r.share for r in shares(spark, rows)}
    assert len(got) == len(rows)
    for g in {r[0] for r in rows}:
        mine = sorted((r[1], r[2], r[3]) for r in rows if r[0] == g)
        assert [(line, got[g, line]) for line, _, _ in mine] == brute_force(mine)


def test_hot_group_is_spread_over_tasks(spark):
    df = spark.range(20000).selectExpr("'hot' g", "int(id) line", "1L weight", "777L amount")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = allocate(df, {"share": "amount"}, "weight", ["g"], ["line"])
        per_task = out.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in per_task) < 12000 and len(per_task) > 2
        assert out.agg(F.sum("share")).first()[0] == 777
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("unit", [None, ["o"]])
def test_pages_and_units(spark, monkeypatch, unit):
    """Small pages, so that units and groups have several; also groups and units without a name."""
    monkeypatch.setattr(allocation, "PAGE", 7)
    rng = random.Random(3)
    rows = []
    for g in ["a", "b", None, "zero"]:
        for o in rng.sample([None, *"klmnopq"], 5):
            rows += [(g, o, i, 0 if g == "zero" else rng.choice([0, 1, 7, 500, None, -3]), 98765) for i in range(-3, rng.choice([0, 2, 30, 100]))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o string, line int, weight bigint, amount bigint")
    group, order = (["g"], ["o", "line"]) if unit else (["g", "o"], ["line"])
    got = {(r.g, r.o, r.line): r.share for r in allocate(df, {"share": "amount"}, "weight", group, order, unit=unit, page="line").collect()}
    assert len(got) == len(rows)
    for key in {r[:len(group)] for r in rows}:
        mine = sorted(((r[1] is not None, r[1] or "", r[2]), r[3], r[4]) for r in rows if r[:len(group)] == key)
        mine = [((o if named else None, line), w, a) for (named, o, line), w, a in mine]
        assert [((o, line), got[key[0], o, line]) for (o, line), _, _ in mine] == brute_force(mine)


def test_a_long_unit_is_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(allocation, "PAGE", 1000)
    df = spark.range(20000).selectExpr("'hot' g", "'o' o", "int(id) line", "1L weight", "777L amount")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = allocate(df, {"share": "amount"}, "weight", ["g", "o"], ["line"], page="line")
        per_task = out.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in per_task) < 12000 and len(per_task) > 2
        assert out.agg(F.sum("share")).first()[0] == 777
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_null_amount_gives_null_parts(spark):
    assert {r.share for r in shares(spark, [("g", 1, 5, None), ("g", 2, 5, None)])} == {None}


def test_products_beyond_64_bits(spark):
    rows = [("g", i, 10**17 + i, 10**17) for i in range(5)]
    got = sorted((r.line, r.share) for r in shares(spark, rows))
    assert got == brute_force([(r[1], r[2], r[3]) for r in rows])


def test_lines_alike_but_for_a_cent_keep_their_places(spark):
    """Repeated lines differ in the cent that rounding gave them; the order rows arrive in decides nothing."""
    lines = spark.createDataFrame([("m", "o", "rappi", 1, "s", 1, 100, "2001-01-01 00:00:00", 1000)] * 7,
        "merchant_id string, order_id string, source_marketplace string, line_item_no int, line_item_sku string, "
        "line_item_qty int, line_item_unit_price bigint, created_at string, total_amount bigint").withColumn(
        "created_at", F.col("created_at").cast("timestamp_ntz"))
    costs = spark.createDataFrame([], "merchant_id string, line_item_sku string, recipe_cost bigint, packaging_cost bigint")
    fact = stage(star.allocated_fact(lines, costs, place="at"), "fact")
    assert sorted(r["at"] for r in fact.collect()) == list(range(1, 8))
    days = spark.createDataFrame([("m", dt.date(2001, 1, 1), 853, 7, "")],
        "merchant_id string, report_date date, net_payout_amount bigint, settlement_variance_amount bigint, variance_reason string")
    got = [sorted((r.gross_order_value, r.net_payout_amount, r.settlement_variance_amount) for r in
                  settlement.fact_with_settlement(fact.coalesce(1).sortWithinPartitions(by), days, place="at").collect())
           for by in (F.col("at"), F.col("at").desc())]
    assert got[0] == got[1] and sum(r[1] for r in got[0]) == 853
