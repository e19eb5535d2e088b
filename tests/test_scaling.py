"""Work that grew with the data in one task, one directory each or one expression each."""

from pyspark.sql import functions as F

from tablemargin import session
from tablemargin.plans import build, registry, shared_tables
from tablemargin.plans.queries import report_state
from tablemargin.plans.shared_tables import SharedTables
from tablemargin.schemas import BRONZE_ORDERS
from tablemargin.sources import variant
from tablemargin.sources.tables import stage, write_table

SF_DIR = "/root/testdata/sf0.001"


def test_cost_rows_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(shared_tables, "PARTS_OF_A_TASK", 50, raising=False)
    costs = SharedTables(spark, SF_DIR).cogs()
    rows = [r["count"] for r in costs.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(rows) > 1 and max(rows) <= 2 * 50 * shared_tables.MERCHANTS


def test_report_gate_lands_few_directories(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(report_state, "scratch_path", lambda _, name: str(tmp_path / name))
    registry.QUERIES["report_gate"](spark, SF_DIR).collect()
    assert 0 < len({p.parent for p in tmp_path.rglob("*.parquet")}) < 20


def test_report_jobs_are_computed_once(spark):
    t = SharedTables(spark, SF_DIR)
    t.keep_report_jobs()
    for frame in (t.bronze_enqueue(), t.bronze_result()):
        assert frame.count() and not any("orders.parquet" in f for f in frame.inputFiles())


def test_misfits_take_a_document_apart_once(spark):
    assert str(variant._misfit(F.col("payload"), BRONZE_ORDERS)).count("payload") <= 3


def test_what_is_staged_is_zstandard_and_tables_are_snappy(spark, tmp_path):
    rows = session.own_session(spark).range(10)
    assert all(f.endswith(".zstd.parquet") for f in stage(rows, "small").inputFiles())
    write_table(rows, str(tmp_path / "table"))
    assert all(f.endswith(".snappy.parquet") for f in spark.read.parquet(str(tmp_path / "table")).inputFiles())


def test_a_build_deletes_its_shuffle_files(spark, monkeypatch, tmp_path):
    """While it builds, not after it: what the caller computes may be read twice."""
    seen = []

    def build_nothing(wh, *rest):
        seen.append(wh.spark.conf.get(session.CLEANUP))
        return wh.spark.createDataFrame([("t", 1)], "table_name string, failing_rows long")

    before = spark.conf.get(session.CLEANUP, None)
    monkeypatch.setattr(build, "_build", build_nothing)
    build.build(build.Warehouse(spark, str(tmp_path), "salt"))
    assert seen == ["true"] and spark.conf.get(session.CLEANUP, None) == before
