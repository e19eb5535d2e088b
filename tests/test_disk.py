"""What queries keep on disk at a time."""

import datetime as dt
import time

from pyspark.sql import functions as F

from tablemargin.operators import incremental, merge, star
from tablemargin.sources import bronze, tables
from tablemargin.sources.tables import stage


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files made since; they are deleted a little after their execution ends."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            return left
        time.sleep(0.1)
    return left


def test_shuffle_files_go_when_a_table_is_staged(spark):
    before = shuffle_files(spark)
    found = stage(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count(), "counted")
    assert not left_over(spark, before) and found.count() == 700


def test_a_small_side_is_broadcast_before_the_other_is_shuffled(spark, monkeypatch):
    days = spark.createDataFrame([(i, "x" * 50) for i in range(100)], "k int, reason string")
    plan = lambda df: spark.range(10).join(df, F.col("id") == F.col("k"))._jdf.queryExecution().optimizedPlan().toString()
    small = plan(tables.stage_to_join(days, "days"))
    monkeypatch.setattr(tables, "BROADCAST_BYTES", 5000)
    assert "broadcast" in small and "broadcast" not in plan(tables.stage_to_join(days, "days"))


def test_split_lines_are_staged_before_the_costs_are_joined(spark):
    """The same rows either way."""
    lines = spark.createDataFrame(
        [("m", f"o{i // 3}", "ubereats", i % 3 + 1, f"s{i % 2}", 1 + i % 4, 100, dt.datetime(2024, 1, 1), 1000) for i in range(30)] + [
         ("m", "o0", "ubereats", 4, None, None, None, dt.datetime(2024, 1, 1), 1000)],
        "merchant_id string, order_id string, source_marketplace string, line_item_no int, line_item_sku string, line_item_qty int, "
        "line_item_unit_price long, created_at timestamp_ntz, total_amount long")
    costs = spark.createDataFrame([("m", "s0", 5, 1)], "merchant_id string, line_item_sku string, recipe_cost long, packaging_cost long")
    staged = star.allocated_fact(lines, costs, staged=True)
    assert sorted(staged.collect(), key=str) == sorted(star.allocated_fact(lines, costs).collect(), key=str)
    assert any("split-lines" in f for f in staged.inputFiles())


def test_landing_rows_are_written_in_parts_of_whole_directories(spark, tmp_path):
    rows = spark.createDataFrame([(f"m{i % 7}", "orders", dt.date(2024, 1, 1 + i % 3), dt.datetime(2024, 2, 1), f"{{}}{i}") for i in range(200)],
                                 "merchant_id string, endpoint string, target_date date, run_timestamp_utc timestamp_ntz, payload string")
    before = shuffle_files(spark)
    bronze.write_bronze(rows, str(tmp_path / "landing"))
    assert not left_over(spark, before)
    read = spark.read.parquet(str(tmp_path / "landing"))
    # One job commits a directory: a file name holds its job's id.
    jobs = read.select("merchant_id", "day", F.regexp_extract("_metadata.file_name", "part-[0-9]+-([0-9a-f-]{36})", 1).alias("job")).distinct()
    assert jobs.count() == 21 and jobs.select("job").distinct().count() > 1
    assert sorted(r.payload for r in read.collect()) == sorted(r.payload for r in rows.collect())


def test_large_merges_go_in_parts_of_whole_partitions(spark, tmp_path, monkeypatch):
    """The rows are those of a merge in one part; a NULL partition and a key that moves are among them."""
    schema = "k int, v string, p string"
    held = spark.createDataFrame([(i, "old", f"p{i % 5}" if i % 7 else None) for i in range(60)], schema)
    new = spark.createDataFrame([(i, "new", f"p{i % 4}" if i % 9 else None) for i in range(0, 90, 2)], schema)
    found = []
    for name, size in (("parts", 1), ("one", 1 << 40)):
        staged, path = [], str(tmp_path / name)
        monkeypatch.setattr(merge, "PART_BYTES", size)
        monkeypatch.setattr(merge, "stage", lambda df, name, *rest: staged.append(name) or stage(df, name, *rest))
        for rows in (held, new):
            merge.merge_replace(path, rows, ["k"], ["p"])
        found.append(sorted(spark.read.schema(schema).parquet(path).collect(), key=str))
        assert staged.count("merge-out") == (merge.MOST_PARTS if size == 1 else 1)
    assert found[0] == found[1] and len(found[0]) == 75


def test_superseded_runs_are_told_by_keys(spark):
    """NULL keys and NULL runs count as they do in `latest_run_wins`."""
    rows = [("a", "x", 1), ("a", "x", 2), ("a", "x", 2), ("a", None, 1), ("a", None, 2), ("b", "x", None), ("b", "x", 3), ("c", "x", None),
            ("d", "x", 5), ("d", "x", 5)]
    df = spark.createDataFrame(rows, "k string, l string, run int")
    older = tables.stage_to_join(incremental.superseded_keys(df, ["k", "l"], "run"), "older")
    got = incremental.without_superseded(df, older, ["k", "l"], "run")
    assert sorted(got.collect(), key=str) == sorted(incremental.latest_run_wins(df, ["k", "l"], "run").collect(), key=str)
    assert older.count() == 2 and "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
