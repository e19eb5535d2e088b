"""Data-quality checks as data: one pass per table, one result row per check."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablemargin.functions.naming import MERCHANT_ID_PATTERN
from tablemargin.sources.tables import replace_table

RESULT = ["table_name", "check_name", "severity", "failing_rows"]


@dataclass(frozen=True)
class Check:
    """`failing` is true on the rows that break the check."""

    name: str
    failing: Column
    severity: str = "error"


class QualityError(RuntimeError):
    """An error-severity check failed; nothing was published."""


def not_null(columns: list[str], severity: str = "error", only_if: Column | None = None) -> list[Check]:
    """One check per column.  `only_if` limits them to the rows where it is true."""
    def failing(c):
        missing = F.col(c).isNull()
        return missing & F.coalesce(only_if, F.lit(False)) if only_if is not None else missing
    return [Check(f"not_null_{c}", failing(c), severity) for c in columns]


def expect(name: str, predicate: Column | str, severity: str = "error") -> Check:
    """Rows where `predicate` is false fail; where it is NULL they pass (not_null is a check of its own)."""
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    return Check(name, ~condition, severity)


def run_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """All row checks of a table in one aggregation."""
    counts = df.agg(*[F.count_if(c.failing).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c.name).alias("check_name"),
                 F.lit(c.severity).alias("severity"), F.col(f"c{i}").alias("failing_rows"))
        for i, c in enumerate(checks)])
    return counts.select(F.inline(rows))


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    return df.where(check.failing)


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).where(F.col("duplicate_count") > 1)


def duplicate_rows(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """All rows whose key is duplicated, sorted by key."""
    repeated = duplicate_groups(df, keys).select(*keys)
    return df.join(repeated, keys, "left_semi").select(*(columns or df.columns)).orderBy(*keys)


def check_unique(df: DataFrame, table: str, keys: list[str], severity: str = "error") -> DataFrame:
    """One result row: the number of duplicated keys."""
    return duplicate_groups(df, keys).agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(table).alias("table_name"), F.lit("unique_" + "_".join(keys)).alias("check_name"),
        F.lit(severity).alias("severity"), "failing_rows")


def hash_stable(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows present in both builds whose hashes differ."""
    before = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in columns])
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in columns])
    return new.select(*keys, *columns).join(before, keys).where(differs)


def quarantine_nulls(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with NULLs set to 0 and flagged `is_anomaly`, the anomalies as they came)."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    kind = {f.name: f.dataType for f in df.schema}
    filled = df.withColumn("is_anomaly", missing).withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast(kind[c])) for c in columns})
    return filled, df.where(missing)


def gate(results: DataFrame) -> DataFrame:
    """One verdict row: failed errors block publishing, failed warnings are only counted."""
    failed = F.col("failing_rows") > 0
    return results.agg(
        F.count_if(failed & (F.col("severity") == "error")).alias("failed_errors"),
        F.count_if(failed & (F.col("severity") == "warn")).alias("failed_warnings"),
        F.count(F.lit(1)).alias("checks_run"),
    ).withColumn("publish", F.col("failed_errors") == 0)


def enforce(results: DataFrame) -> None:
    """Raise with the failed checks' names unless every error-severity check passed."""
    failed = results.where((F.col("failing_rows") > 0) & (F.col("severity") == "error")).collect()
    if failed:
        raise QualityError("; ".join(f"{r.table_name}.{r.check_name}: {r.failing_rows}" for r in failed))


def publish(staged: DataFrame, results: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """Replace the table at `path` by `staged` if the gate is open, otherwise raise."""
    enforce(results)
    replace_table(staged, path, partitions)


def silver_orders_checks() -> list[Check]:
    return [
        *not_null(["order_id", "source_marketplace", "merchant_id", "target_date", "total_amount",
                   "total_currency", "customer_name_hash_salted", "customer_phone_hash_salted"]),
        expect("line_item_qty_positive", "line_item_qty > 0"),
        expect("total_amount_non_negative", "total_amount >= 0"),
        expect("total_amount_not_zero", "total_amount <> 0", "warn"),
        expect("currency_three_letters", "total_currency rlike '^[A-Z]{3}$'", "warn"),
        expect("merchant_id_well_formed", f"merchant_id rlike '{MERCHANT_ID_PATTERN}'", "warn"),
    ]


def silver_reports_checks(warn_status: str = "warn") -> list[Check]:
    """Result columns are only required of READY jobs, so a pending job does not block the build."""
    ready = F.col("result_status") == "READY"
    return [
        *not_null(["job_id", "merchant_id", "report_date", "enqueue_at"]),
        *not_null(["result_status", "gross_sales_amount", "net_payout_amount"], only_if=ready),
        expect("no_warn_status", "result_status <> 'WARN'", warn_status),
    ]


def tenant_isolation(severity: str = "warn") -> Check:
    """Landing path and payload must name the same merchant."""
    return expect("path_merchant_is_payload_merchant", "path_merchant_id = merchant_id", severity)


def page_complete(severity: str = "warn") -> Check:
    return Check("page_complete", F.col("next_cursor").isNotNull(), severity)


def check_silver_orders(silver: DataFrame) -> DataFrame:
    """Row checks on lines, uniqueness of lines and of order headers."""
    from tablemargin.operators.flatten import order_headers

    lines = run_checks(silver, "silver_orders", silver_orders_checks())
    by_line = check_unique(silver, "silver_orders", ["order_id", "source_marketplace", "line_item_no"])
    by_order = check_unique(order_headers(silver), "silver_orders", ["order_id", "source_marketplace"])
    return lines.unionByName(by_line).unionByName(by_order)


def check_silver_reports(reports: DataFrame, warn_status: str = "warn") -> DataFrame:
    return run_checks(reports, "silver_reports", silver_reports_checks(warn_status)).unionByName(
        check_unique(reports, "silver_reports", ["job_id"]))


def check_dim(dim: DataFrame) -> DataFrame:
    return run_checks(dim, "dim_menu_catalog", not_null(["merchant_id", "line_item_sku"])).unionByName(
        check_unique(dim, "dim_menu_catalog", ["merchant_id", "line_item_sku"]))


def check_fact(fact: DataFrame) -> DataFrame:
    return run_checks(fact, "fact_financial_sales", not_null(
        ["merchant_id", "order_id", "source_marketplace", "line_item_sku"]))


def check_cogs(cogs: DataFrame) -> DataFrame:
    return run_checks(cogs, "merchant_cogs", not_null(["merchant_id", "line_item_sku"])).unionByName(
        check_unique(cogs, "merchant_cogs", ["merchant_id", "line_item_sku"]))


def check_salts(salts: DataFrame, tenant: str = "merchant_id") -> DataFrame:
    """Every tenant has one salt."""
    return run_checks(salts, "tenant_salts", not_null([tenant, "pii_salt"])).unionByName(
        check_unique(salts, "tenant_salts", [tenant]))


def check_unique_in_table(conflicts: DataFrame, table: str, keys: list[str], severity: str = "error") -> DataFrame:
    """One result row: the number of incoming keys that the table already has under another owner."""
    return conflicts.select(*keys).distinct().agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(table).alias("table_name"), F.lit("unique_in_table_" + "_".join(keys)).alias("check_name"),
        F.lit(severity).alias("severity"), "failing_rows")


def document_parsed(severity: str = "error") -> Check:
    """A landed document that is no JSON of its endpoint: its rows would be missing without a trace."""
    return Check("document_parsed", F.col("_corrupt_record").isNotNull(), severity)


def check_landing(bronze: DataFrame, endpoint: str = "orders") -> DataFrame:
    """What must hold of an endpoint's landed documents before they are used."""
    corrupt = "_corrupt_record" in bronze.columns
    parsed = F.col("_corrupt_record").isNull() if corrupt else F.lit(True)
    checks = [page_complete()] if endpoint == "orders" else [Check("job_id_present", F.col("jobId").isNull() & parsed, "warn")]
    if corrupt:
        checks.append(document_parsed())
    return run_checks(bronze, f"bronze_{endpoint}", checks)
