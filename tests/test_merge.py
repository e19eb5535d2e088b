"""Keyed merges into partitioned Parquet tables."""

import os
import random

import pytest

from tablemargin.operators import merge
from tablemargin.operators.merge import merge_replace
from tablemargin.sources.tables import exists, read_table, replace_table, stage, write_table

SCHEMA = "id string, item int, v int, run int, m string, d string"
KEYS = ["m", "id"]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def held(spark, path, schema=SCHEMA):
    return sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect())


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "table")


def test_first_merge_creates_the_table(spark, path):
    merge_replace(path, frame(spark, [("a", 1, 1, 1, "007", "d1")]), KEYS, ["m", "d"])
    assert held(spark, path) == [("a", 1, 1, 1, "007", "d1")]
    assert os.path.isdir(os.path.join(path, "m=007", "d=d1"))


def test_all_rows_of_a_key_are_replaced(spark, path):
    merge_replace(path, frame(spark, [("a", 1, 1, 1, "m1", "d1"), ("a", 2, 1, 1, "m1", "d1"),
                                      ("b", 1, 1, 1, "m1", "d1"), ("a", 1, 9, 1, "m2", "d1")]), KEYS, ["m", "d"])
    merge_replace(path, frame(spark, [("a", 1, 5, 2, "m1", "d1")]), KEYS, ["m", "d"])
    assert held(spark, path) == [("a", 1, 5, 2, "m1", "d1"), ("a", 1, 9, 1, "m2", "d1"), ("b", 1, 1, 1, "m1", "d1")]


def test_key_that_moves_leaves_its_old_partition(spark, path):
    merge_replace(path, frame(spark, [("a", 1, 1, 1, "m1", "d1"), ("b", 1, 1, 1, "m1", "d1")]), KEYS, ["m", "d"])
    merge_replace(path, frame(spark, [("a", 1, 2, 2, "m1", "d2")]), KEYS, ["m", "d"])
    assert held(spark, path) == [("a", 1, 2, 2, "m1", "d2"), ("b", 1, 1, 1, "m1", "d1")]


def test_partition_that_becomes_empty_is_dropped(spark, path):
    merge_replace(path, frame(spark, [("a", 1, 1, 1, "m1", "d 1/x"), ("b", 1, 1, 1, "m1", "d3")]), KEYS, ["m", "d"])
    merge_replace(path, frame(spark, [("a", 1, 2, 2, "m1", "d2")]), KEYS, ["m", "d"])
    assert held(spark, path) == [("a", 1, 2, 2, "m1", "d2"), ("b", 1, 1, 1, "m1", "d3")]
    assert sorted(os.listdir(os.path.join(path, "m=m1"))) == ["d=d2", "d=d3"]


def test_other_partitions_are_not_rewritten(spark, path):
    merge_replace(path, frame(spark, [("a", 1, 1, 1, "m1", "d1"), ("b", 1, 1, 1, "m2", "d1")]), KEYS, ["m", "d"])
    untouched = os.path.join(path, "m=m2", "d=d1")
    before = sorted(os.listdir(untouched))
    merge_replace(path, frame(spark, [("a", 1, 2, 2, "m1", "d1")]), KEYS, ["m", "d"])
    assert sorted(os.listdir(untouched)) == before


def test_source_may_read_the_table(spark, path):
    merge_replace(path, frame(spark, [("a", 1, 1, 1, "m1", "d1"), ("b", 1, 1, 1, "m1", "d2")]), KEYS, ["m", "d"])
    source = spark.read.schema(SCHEMA).parquet(path).selectExpr("id", "item", "v + 10 v", "run", "m", "d")
    merge_replace(path, source, KEYS, ["m", "d"])
    assert [r[2] for r in held(spark, path)] == [11, 11]


def test_null_keys_and_null_partitions_stay_idempotent(spark, path):
    rows = [(None, 1, 1, 1, "m1", None), ("b", 1, 1, 1, "m1", "d1")]
    for _ in range(3):
        merge_replace(path, frame(spark, rows), KEYS, ["m", "d"])
    assert spark.read.schema(SCHEMA).parquet(path).count() == 2


def test_older_version_does_not_replace_newer(spark, path):
    merge_replace(path, frame(spark, [("a", 1, 1, 5, "m1", "d1")]), KEYS, ["m", "d"], version="run")
    merge_replace(path, frame(spark, [("a", 1, 2, 4, "m1", "d1"), ("b", 1, 2, 4, "m1", "d1")]), KEYS, ["m", "d"],
                  version="run")
    assert held(spark, path) == [("a", 1, 1, 5, "m1", "d1"), ("b", 1, 2, 4, "m1", "d1")]
    merge_replace(path, frame(spark, [("a", 1, 3, 6, "m1", "d1")]), KEYS, ["m", "d"], version="run")
    assert held(spark, path)[0] == ("a", 1, 3, 6, "m1", "d1")


def test_new_column_needs_evolve(spark, path):
    merge_replace(path, frame(spark, [("a", 1, "m1"), ("b", 1, "m2")], "id string, v int, m string"),
                  ["id"], ["m"])
    wider = frame(spark, [("a", 2, "x", "m1")], "id string, v int, extra string, m string")
    with pytest.raises(ValueError):
        merge_replace(path, wider, ["id"], ["m"])
    merge_replace(path, wider, ["id"], ["m"], evolve=True)
    rows = {r.id: (r.v, r.extra) for r in read_table(spark, path).collect()}
    assert rows == {"a": (2, "x"), "b": (1, None)}
    # A later source without the new column keeps it for the others.
    merge_replace(path, frame(spark, [("c", 3, "m1")], "id string, v int, m string"), ["id"], ["m"], evolve=True)
    rows = {r.id: (r.v, r.extra) for r in read_table(spark, path).collect()}
    assert rows == {"a": (2, "x"), "b": (1, None), "c": (3, None)}


def test_unpartitioned_table(spark, path):
    schema = "id string, v int"
    merge_replace(path, frame(spark, [("a", 1), ("b", 1)], schema), ["id"], [])
    merge_replace(path, frame(spark, [("a", 2), ("c", 2)], schema), ["id"], [])
    assert held(spark, path, schema) == [("a", 2), ("b", 1), ("c", 2)]


@pytest.mark.parametrize("seed", range(3))
def test_merges_against_a_dictionary(spark, path, seed):
    """Random batches with moving keys equal a dictionary that replaces whole keys."""
    rng = random.Random(seed)
    model = {}
    for run in range(4):
        batch = {}
        for key in rng.sample("abcdefgh", 4):
            merchant, day = rng.choice(["m1", "m2"]), rng.choice(["d1", "d2", "d3"])
            batch[merchant, key] = [(key, i, rng.randint(0, 9), run, merchant, day)
                                    for i in range(rng.randint(1, 3))]
        model.update(batch)
        merge_replace(path, frame(spark, [r for rows in batch.values() for r in rows]), KEYS, ["m", "d"])
        assert held(spark, path) == sorted(r for rows in model.values() for r in rows)


def test_partitions_are_pruned_without_literals(spark, path):
    write_table(frame(spark, [(str(i), 1, 1, 1, f"m{i}", "d1") for i in range(30)]), path, ["m", "d"])
    target = spark.read.schema(SCHEMA).parquet(path)
    wanted = spark.createDataFrame([("m3", "d1"), ("m7", "d1")], "m string, d string")
    pruned = merge.prune(target, wanted, ["m", "d"])
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    assert " IN (" not in text and sorted(r.id for r in pruned.collect()) == ["3", "7"]


def test_null_partitions_are_found(spark, path):
    write_table(frame(spark, [("a", 1, 1, 1, "m1", None), ("b", 1, 1, 1, "m1", "d1"), ("c", 1, 1, 1, "m2", "d2")]), path, ["m", "d"])
    target = spark.read.schema(SCHEMA).parquet(path)
    wanted = spark.createDataFrame([("m1", None), ("m1", "d1")], "m string, d string")
    assert sorted(r.id for r in merge.prune(target, wanted, ["m", "d"]).collect()) == ["a", "b"]


def test_plain_merge_after_an_evolving_one(spark, path):
    merge_replace(path, frame(spark, [("a", 1, "m1"), ("b", 1, "m2")], "id string, v int, m string"), ["id"], ["m"])
    wider = "id string, v int, extra string, m string"
    merge_replace(path, frame(spark, [("a", 2, "x", "m1")], wider), ["id"], ["m"], evolve=True)
    merge_replace(path, frame(spark, [("c", 3, "y", "m2")], wider), ["id"], ["m"])
    assert {r.id: (r.v, r.extra) for r in read_table(spark, path).collect()} == {"a": (2, "x"), "b": (1, None), "c": (3, "y")}


def test_an_empty_table_can_be_merged_into(spark, path):
    merge_replace(path, frame(spark, []), KEYS, ["m", "d"])
    merge_replace(path, frame(spark, [("a", 1, 1, 1, "m1", "d1")]), KEYS, ["m", "d"])
    assert held(spark, path) == [("a", 1, 1, 1, "m1", "d1")]


def test_versions_within_one_source(spark, path):
    rows = [("a", 1, 1, 1, "m1", "d1"), ("a", 1, 2, 2, "m1", "d1"), ("a", 2, 2, 2, "m1", "d1"), ("b", 1, 1, 1, "m1", "d1")]
    for _ in range(2):
        merge_replace(path, frame(spark, rows), KEYS, ["m", "d"], version="run")
        assert held(spark, path) == [("a", 1, 2, 2, "m1", "d1"), ("a", 2, 2, 2, "m1", "d1"), ("b", 1, 1, 1, "m1", "d1")]


def test_cleared_keys_lose_their_rows(spark, path):
    merge_replace(path, frame(spark, [("a", 1, 1, 5, "m1", "d1"), ("b", 1, 1, 5, "m1", "d1"), ("c", 1, 1, 5, "m1", "d2")]), KEYS, ["m", "d"])
    gone = spark.createDataFrame([("m1", "a", 6), ("m1", "b", 4), ("m1", "c", 6)], "m string, id string, run int")
    merge_replace(path, frame(spark, [("e", 1, 1, 6, "m1", "d1")]), KEYS, ["m", "d"], version="run", clear=gone)
    assert [r[0] for r in held(spark, path)] == ["b", "e"]


def test_full_refresh_from_itself(spark, path):
    write_table(frame(spark, [("a", 1)], "id string, v int"), path)
    replace_table(spark.read.schema("id string, v int").parquet(path).selectExpr("id", "v + 1 v"), path)
    assert held(spark, path, "id string, v int") == [("a", 2)]
    assert sorted(os.listdir(os.path.dirname(path))) == ["table"] and exists(spark, path)


LEDGER = ("merchant_id string, line_item_sku string, recipe_cost decimal(10,4), packaging_cost decimal(10,4), "
          "updated_at timestamp_ntz")


def ledger(spark, rows):
    return spark.sql("select * from values " + ", ".join(
        f"('{m}', '{s}', cast({r} as decimal(10,4)), cast({p} as decimal(10,4)), timestamp_ntz'2026-01-0{d}')"
        for m, s, r, p, d in rows) + " as t(merchant_id, line_item_sku, recipe_cost, packaging_cost, updated_at)")


def test_cost_edits(spark):
    start = ledger(spark, [("store_001", "BURGER", 1, 1, 1), ("store_002", "FRIES", 2, 2, 1)])
    edits = ledger(spark, [("store_001", "BURGER", 3.5, 0.8, 2), ("store_001", "BURGER", 4.2, 0.9, 3),
                           ("store_001", "COLA", 1, 0.1, 2)])
    rows = {(r.merchant_id, r.line_item_sku): (float(r.recipe_cost), float(r.packaging_cost))
            for r in merge.upsert_cogs(start, edits).collect()}
    assert rows == {("store_001", "BURGER"): (4.2, 0.9), ("store_001", "COLA"): (1.0, 0.1),
                    ("store_002", "FRIES"): (2.0, 2.0)}
    gone = ledger(spark, [("store_001", "BURGER", 0, 0, 1), ("store_009", "NOTHING", 0, 0, 1)])
    assert [r.line_item_sku for r in merge.delete_cogs(start, gone).collect()] == ["FRIES"]


def test_a_settled_source_is_not_staged_again(spark, path, monkeypatch):
    staged = []

    def noted(df, name, *rest):
        staged.append(name)
        return stage(df, name, *rest)

    monkeypatch.setattr(merge, "stage", noted)
    keys = "id string, m string, run int"
    for rows, gone in (([("a", 1, 5, 2, "m1", "d1"), ("a", 2, 5, 2, "m1", "d1"), ("b", 1, 5, 2, "m1", "d2")], []),
                       ([("a", 1, 4, 1, "m1", "d1"), ("b", 1, 6, 3, "m1", "d3")], []),
                       ([("c", 1, 7, 4, None, "d1")], [("b", "m1", 2), ("a", "m1", 4)])):
        merge_replace(path, frame(spark, rows), KEYS, ["m", "d"], version="run", clear=frame(spark, gone, keys), settled=True)
    assert "merge-in" not in staged
    assert sorted(map(str, held(spark, path))) == [str(("b", 1, 6, 3, "m1", "d3")), str(("c", 1, 7, 4, None, "d1"))]
