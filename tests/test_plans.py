"""What the planner makes of our operators."""

import re

import pytest
from pyspark.sql import functions as F

from tablemargin.operators import incremental, serving, star
from tablemargin.plans import registry
from tablemargin.plans.shared_tables import SharedTables
from tablemargin.session import own_session
from tablemargin.sources.tables import write_table

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def t(spark):
    return SharedTables(spark, SF_DIR)


def test_tenant_fence_prunes_directories(spark, t, tmp_path):
    path = str(tmp_path / "orders")
    write_table(t.headers(), path, ["merchant_id"])
    text = plan(serving.tenant(spark.read.parquet(path), merchant_id="store_003"))
    assert re.search(r"PartitionFilters: \[[^]]*merchant_id[^]]*store_003", text)


def test_fact_reads_only_its_columns(t):
    text = plan(star.fact_financial_sales(t.lines(), t.cogs()))
    lineitem = re.search(r"ReadSchema: struct<l_orderkey[^>]*>", text).group()
    assert "l_extendedprice" not in lineitem and "l_comment" not in lineitem
    assert "sha2" not in text


def test_no_python_in_any_plan(spark):
    writing = {"merge_silver_orders", "merge_silver_reports", "merge_dim", "merge_fact", "merge_with_new_column",
               "full_refresh", "incremental_build", "late_and_stopped_build", "costs_saved_then_built", "landing_gate",
               "stream_backlog", "landing_as_table", "cogs_seed", "stream_ingest", "landing_round_trip", "report_pair_round_trip",
               "materialized_table", "late_results_build", "streamed_report_join", "quarantined_orders", "report_gate",
               "variant_round_trip", "unknown_document_fields", "promoted_fields", "fields_promoted_later", "variant_gate",
               "sql_tenant_sales"}
    # These stage the same rows as fact_with_settlement, which is looked at.
    writing |= {"kpi_tenant", "kpi_by_merchant", "profit_leakage", "payout_by_day", "variance_log",
                "list_fact_financial_sales", "silver_orders_table"}
    for name, run in registry.QUERIES.items():
        if name in writing:
            continue
        text = plan(run(spark, SF_DIR))
        assert not re.search(r"Python|Pandas|Arrow(?!ToRow)", text), name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_latest_run_shuffles_each_side_once(spark, t):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = t.headers().select("order_id", "created_at", "total_amount")
        assert plan(incremental.latest_run_wins(df, ["order_id"], "created_at")).count("Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sums_are_combined_before_the_shuffle(t):
    fact = star.fact_financial_sales(t.lines(), t.cogs()).withColumn("net_payout_amount", F.lit(0).cast("bigint"))
    text = plan(serving.profit_leakage(fact))
    assert "partial_sum" in text and "SortAggregate" not in text


def test_top_k_sorts_within_tasks(t):
    fact = star.fact_financial_sales(t.lines(), t.cogs())
    assert "TakeOrderedAndProject" in plan(serving.menu_engineering(fact, k=5))


def test_exploded_costs_are_not_broadcast_by_estimate(spark):
    """The planner takes the cost table for as small as the parts it is exploded from."""
    registry.load()
    for name in ("cogs_delete", "cogs_upsert", "allocated_fact", "menu_cogs_grid", "join_cogs"):
        assert "BroadcastExchange" not in plan(registry.QUERIES[name](spark, SF_DIR)), name


def test_tasks_grow_in_number_and_not_in_size(spark):
    """However few shuffle partitions the caller asks for, what one task reads is bounded."""
    session = own_session(spark)
    assert int(session.conf.get("spark.sql.shuffle.partitions")) < 100
    found = session.range(0, 3_000_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).groupBy("k").count()
    found.write.format("noop").mode("overwrite").save()
    assert found.rdd.getNumPartitions() >= 10


def test_documents_shuffle_no_hashes(t):
    """Hashes, SKUs and currencies are made after the last shuffle of the documents."""
    text = plan(t.order_documents())
    assert "sha2" in text and "SKU_" in text
    below = text[text.index("Exchange"):]
    assert "sha2" not in below and "SKU_" not in below
