"""The medallion build: landing documents to line, report, menu and sales tables."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablemargin.functions.money import COMMISSION_RATE
from tablemargin.operators import quality
from tablemargin.operators.flatten import ORDER_KEY, conform_lines, flatten_orders, order_headers
from tablemargin.operators.incremental import latest_run_wins, superseded_keys, without_superseded
from tablemargin.operators.key_index import KeyIndex
from tablemargin.operators.merge import last_edits, merge_replace, with_keys, without_keys
from tablemargin.operators.reports import flat_requests, flat_results, newer_half, report_rows
from tablemargin.operators.settlement import fact_with_settlement, settlement_reconciliation
from tablemargin.operators.star import (
    ITEM_KEY, allocated_fact, dim_menu_catalog, fact_financial_sales, recompute_affected)
from tablemargin.schemas import COGS_LEDGER, REPORT_REQUESTS, REPORT_RESULTS, SILVER_ORDERS, SILVER_REPORTS
from tablemargin.session import delete_scratch, scratch_noted, scratch_scope, shuffles_deleted
from tablemargin.sources.cogs import cogs_in_minor_units
from tablemargin.sources.tables import delete_path, exists, read_text, replace_table, stage, stage_to_join, write_table, write_text
from tablemargin.sources.versioned import VersionedTable

# Build order; a model only reads those before it.
MODELS = ("silver_orders", "silver_reports", "dim_menu_catalog", "fact_financial_sales", "served_fact")
# Models that take up what the line and report tables changed, each at its own pace.
FOLLOWERS = ("dim_menu_catalog", "fact_financial_sales", "served_fact")
MONTH = ["merchant_id", "target_month"]
# Unique over all merchants.
ORDER_ID = ("order_id", "source_marketplace")
# How long before a build its landing files may have been listed, or a file's time lie before it shows.
OVERLAP = dt.timedelta(days=1)


@dataclass(frozen=True)
class Warehouse:
    """Where the tables live and the build's parameters."""

    spark: SparkSession
    root: str
    salt: str
    rate: Decimal = COMMISSION_RATE
    tz: str = "UTC"
    # Directories of the line and sales tables.  A directory per merchant and day would be too
    # many and too small; `target_month` is added to the rows when it is named here.
    order_partitions: tuple[str, ...] = ("merchant_id", "target_month")
    # What a document whose path names another merchant than its orders means: "error" or "warn".
    isolation: str = "error"
    # With it an order without a total counts as 0 and stands in `anomalies`; else it stops the build.
    quarantine: bool = False

    def path(self, model: str) -> str:
        return f"{self.root}/{model}"

    def read(self, model: str, schema=None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(self.path(model))

    def landing_mark(self, endpoint: str = "orders") -> str | None:
        """For `read_bronze(..., modified_after=...)`: a day before the last build that read the endpoint began.

        Files from that day on are opened again, and those that were processed then are left out by name.
        """
        path = self._mark(endpoint)
        return json.loads(read_text(self.spark, path))["mark"] if exists(self.spark, path) else None

    def note_mark(self, endpoint: str, began: dt.datetime) -> None:
        write_text(self.spark, self._mark(endpoint), json.dumps({"mark": began.strftime("%Y-%m-%dT%H:%M:%S")}))

    def _mark(self, endpoint: str) -> str:
        return f"{self.root}/_progress/landing_mark_{endpoint}.json"

    def report_halves(self) -> dict[str, tuple[VersionedTable, T.StructType]]:
        """What is known of each job's request and of its result, by endpoint."""
        return {endpoint: (VersionedTable(self.spark, self.path(f"_state/{endpoint}"), ["job_id"]), schema)
                for endpoint, schema in (("reports_enqueue", REPORT_REQUESTS), ("reports_result", REPORT_RESULTS))}

    def order_owners(self) -> KeyIndex:
        """Which merchant each order of a marketplace belongs to."""
        return KeyIndex(self.spark, self.path("_index/orders"), list(ORDER_ID), ["merchant_id"])

    def anomalies(self) -> VersionedTable:
        """Orders whose total was missing, as they came; a later run with a total takes them out."""
        return VersionedTable(self.spark, self.path("anomalies"), ORDER_KEY)

    def costs(self, seed: DataFrame | None) -> DataFrame:
        """The saved costs in minor units; the seed fills in for items without any."""
        saved = None
        if exists(self.spark, self.path("merchant_cogs")):
            saved = cogs_in_minor_units(self.read("merchant_cogs", COGS_LEDGER))
        if seed is None or saved is None:
            if seed is None and saved is None:
                raise ValueError("costs are needed: pass `cogs` or save some first")
            return saved if seed is None else seed
        return saved.unionByName(without_keys(seed.select(saved.columns), saved, ITEM_KEY))

    def laid_out(self, df: DataFrame, day: str) -> DataFrame:
        """Rows with the partition columns they lack."""
        if "target_month" in self.order_partitions:
            return df.withColumn("target_month", F.trunc(day, "month"))
        return df


def _trim_changes(wh: Warehouse) -> None:
    """Forget the changes that every model built so far has taken up; one built later begins with everything."""
    takers = [m for m in FOLLOWERS if exists(wh.spark, wh.path(m)) and exists(wh.spark, wh.path(f"_progress/{m}"))]
    if not takers or not exists(wh.spark, wh.path("_changes")):
        return
    # A name for each build since the last trim.
    taken = [{r.batch for r in wh.read(f"_progress/{m}", "batch string").collect()} for m in takers]
    for batch in set.intersection(*taken):
        delete_path(wh.spark, f"{wh.path('_changes')}/batch={batch}")


def build(
    wh: Warehouse, orders: DataFrame | None = None, enqueue: DataFrame | None = None,
    result: DataFrame | None = None, cogs: DataFrame | None = None, stores: DataFrame | None = None,
    select: list[str] | None = None, full_refresh: bool = False,
) -> DataFrame:
    """Build the selected models in order and return the results of all checks run.

    Each model is staged and checked; a failed error check raises before its table changes.
    Without `full_refresh` new landing files are processed and merged by key; with it the tables
    are rebuilt beside the old ones and swapped.  `stores` (merchant_id, store_tz) gives each
    merchant its own calendar day, otherwise `wh.tz` applies.

    Nothing is lost between builds.  Landing files are remembered by path once their orders are
    merged, so a file that arrives late, or a second one of the same second, is processed when it
    comes; documents without a `landing_file` are merged again each time.  An older run never
    replaces a newer one, and an order whose latest run has no items loses its lines, for good.
    What a merge is about to change is logged first, and each model that follows the line and
    report tables takes up all changes it has not yet taken up: a build that stopped half way, or
    built only some models, is caught up by the next.
    """
    with scratch_scope(wh.spark), shuffles_deleted(wh.spark):
        found = _build(wh, orders, enqueue, result, cogs, stores, select, full_refresh)
        _trim_changes(wh)
        # A row for each check: they stay when what was staged goes.
        return wh.spark.createDataFrame(found.collect(), found.schema)


def _build(wh, orders, enqueue, result, cogs, stores, select, full_refresh) -> DataFrame:
    chosen = set(select or MODELS)
    unknown = chosen - set(MODELS)
    if unknown:
        raise ValueError(f"unknown models {sorted(unknown)}")
    began = dt.datetime.now(dt.timezone.utc) - OVERLAP
    results: list[DataFrame] = []

    def checked(found: DataFrame) -> None:
        found = stage(found, "checks")
        quality.enforce(found)
        results.append(found)

    if "silver_orders" in chosen and orders is not None:
        _build_orders(wh, orders, stores, full_refresh, checked)
        wh.note_mark("orders", began)
    given = {e: d for e, d in (("reports_enqueue", enqueue), ("reports_result", result)) if d is not None}
    if "silver_reports" in chosen and given:
        _build_reports(wh, given, stores, full_refresh, checked)
        for endpoint in given:
            wh.note_mark(endpoint, began)
    if not chosen & set(FOLLOWERS) or not exists(wh.spark, wh.path("silver_orders")):
        return _union(results)

    silver = wh.read("silver_orders", SILVER_ORDERS)
    if "dim_menu_catalog" in chosen:
        changed, done = _pending(wh, "dim_menu_catalog", full_refresh)
        # Only merchants with changed lines can have changed names or seen times.
        source = silver if changed is None else silver.join(changed.select("merchant_id").distinct(), "merchant_id", "left_semi")
        dim = stage(dim_menu_catalog(source), "dim")
        checked(quality.check_dim(dim))
        clear = None if changed is None else changed.select("merchant_id").dropna()
        _save(wh, "dim_menu_catalog", dim, ["merchant_id"], ["merchant_id"], changed is None, clear)
        done()
    if chosen & {"fact_financial_sales", "served_fact"}:
        costs = stage(wh.costs(cogs), "costs")
        checked(quality.check_cogs(costs))
    if "fact_financial_sales" in chosen:
        changed, done = _pending(wh, "fact_financial_sales", full_refresh)
        keys = None if changed is None else stage(changed.where("order_id is not null").select(*ORDER_KEY).distinct(), "changed-orders")
        lines = silver if keys is None else silver.join(keys, ORDER_KEY, "left_semi")
        fact = stage(wh.laid_out(
            fact_financial_sales(lines, costs, wh.rate, keep=("target_date",)), "target_date"), "fact")
        checked(quality.check_fact(fact))
        _save(wh, "fact_financial_sales", fact, ORDER_KEY, list(wh.order_partitions), changed is None, keys)
        done()
    if "served_fact" in chosen:
        changed, done = _pending(wh, "served_fact", full_refresh)
        months = None if changed is None else stage(changed.select(*MONTH).distinct(), "changed-months")
        _save(wh, "served_fact", stage(_served(wh, silver, costs, months), "served"), MONTH, MONTH, changed is None, months)
        done()
    return _union(results)


def _build_orders(wh: Warehouse, orders: DataFrame, stores: DataFrame | None, full_refresh: bool, checked) -> None:
    """Merge the orders of all landing files that were not merged before."""
    known = "landing_file" in orders.columns
    if known and not full_refresh and exists(wh.spark, wh.path("_progress/orders")):
        # Before the documents are parsed: the join is on the file's name alone.
        orders = orders.join(wh.read("_progress/orders", "landing_file string"), "landing_file", "left_anti")
    # Parsing nested JSON is the expensive part, so it happens once.
    with scratch_noted() as documents:
        landed = stage(orders, "landed")
    checked(quality.check_landing(landed))
    files = stage(landed.select("landing_file").distinct(), "landed-files") if known else None
    with scratch_noted() as parsed:
        flat = stage(flatten_orders(landed), "orders")
    # What is staged and read no more takes no disk from what follows.
    delete_scratch(wh.spark, documents)
    if "path_merchant_id" in flat.columns:
        checked(quality.run_checks(flat, "bronze_orders", [quality.tenant_isolation(wh.isolation)]))
    emptied_path = wh.path("_progress/emptied_orders")
    run_schema = "merchant_id string, order_id string, source_marketplace string, run_timestamp_utc timestamp_ntz"
    # Taken before the latest runs are told, so that no items are shuffled for it.
    heads = stage(latest_run_wins(flat.select(
        *ORDER_KEY, "run_timestamp_utc", (F.coalesce(F.size("items"), F.lit(0)) <= 0).alias("empty"),
        F.trunc(F.coalesce("created_at", F.lit("1970-01-01").cast("timestamp_ntz")), "month").alias("target_month")),
        ORDER_KEY, "run_timestamp_utc"), "order-heads")
    older = stage_to_join(superseded_keys(flat, ORDER_KEY, "run_timestamp_utc"), "superseded")
    latest, tz = _zoned(wh, without_superseded(flat, older, ORDER_KEY, "run_timestamp_utc"), stores, "merchant_id")
    lines = conform_lines(latest, wh.salt, tz)
    if not full_refresh and exists(wh.spark, emptied_path):
        # An order that a later run emptied stays empty when an older run arrives.
        gone = wh.read("_progress/emptied_orders", run_schema).withColumnRenamed("run_timestamp_utc", "_gone")
        late = heads.join(gone.groupBy(*ORDER_KEY).agg(F.max("_gone").alias("_gone")), ORDER_KEY).where("_gone > run_timestamp_utc")
        lines = without_keys(lines, stage(late.select(*ORDER_KEY), "late-orders"), ORDER_KEY)
    lines = stage(lines, "lines")
    delete_scratch(wh.spark, parsed)
    anomalies = None
    if wh.quarantine:
        filled, anomalies = quality.quarantine_nulls(lines, ["total_amount"])
        lines, anomalies = filled.drop("is_anomaly"), order_headers(anomalies)
    checked(quality.check_silver_orders(lines))
    owners, sold = wh.order_owners(), order_headers(lines).select(*ORDER_KEY)
    if not full_refresh:
        if not owners.exists() and exists(wh.spark, wh.path("silver_orders")):
            owners.rebuild(order_headers(wh.read("silver_orders", SILVER_ORDERS)))
        checked(quality.check_unique_in_table(owners.conflicts(sold), "silver_orders", list(ORDER_ID)))
    clear = heads.where("empty").select(*ORDER_KEY, "run_timestamp_utc")
    laid_out = wh.laid_out(lines, "target_date")
    if full_refresh:
        # What is known of report files stays: reports may not be part of this build.
        for old in ("_changes", *(f"_progress/{x}" for x in ("orders", "emptied_orders", *FOLLOWERS))):
            delete_path(wh.spark, wh.path(old))
        replace_table(laid_out, wh.path("silver_orders"), list(wh.order_partitions))
    else:
        before = None
        if exists(wh.spark, wh.path("silver_orders")):
            # The months that orders leave change, too.
            before = wh.read("silver_orders", SILVER_ORDERS).join(heads.select(*ORDER_KEY), ORDER_KEY, "left_semi").select(
                *ORDER_KEY, F.trunc("target_date", "month").alias("target_month"))
        after = lines.select(*ORDER_KEY, F.trunc("target_date", "month").alias("target_month"))
        touched = after if before is None else after.unionByName(before)
        _log_change(wh, touched.unionByName(heads.where("empty").select(*ORDER_KEY, F.lit(None).cast("date").alias("target_month"))).distinct())
        merge_replace(wh.path("silver_orders"), laid_out, ORDER_KEY, list(wh.order_partitions), evolve=True,
                      version="run_timestamp_utc", clear=clear, settled=True)
    if full_refresh:
        owners.rebuild(sold)
    else:
        # An order that an older run finds empty may have lines in the table still.
        emptied = heads.where("empty").select(*ORDER_KEY)
        held = with_keys(wh.read("silver_orders", SILVER_ORDERS).select(*ORDER_KEY), emptied, ORDER_KEY)
        owners.add(sold, gone=without_keys(emptied, held, ORDER_KEY).select(*ORDER_ID))
    if wh.quarantine and full_refresh:
        wh.anomalies().replace(anomalies)
    elif wh.quarantine:
        # Runs that came too late say nothing about the order any more.
        run = [*ORDER_KEY, "run_timestamp_utc"]
        now = stage(with_keys(wh.read("silver_orders", SILVER_ORDERS).select(*run), heads, run).distinct(), "current-runs")
        wh.anomalies().upsert(with_keys(anomalies, now, run), clear=now.select(*ORDER_KEY))
        wh.anomalies().fold()
    write_table(clear, emptied_path, mode="append")
    if known:
        write_table(files, wh.path("_progress/orders"), mode="append")


def _build_reports(wh: Warehouse, given: dict[str, DataFrame], stores: DataFrame | None, full_refresh: bool, checked) -> None:
    """Take up new request and result documents, whichever come first, and renew the rows of the jobs they touch.

    Each half of a job is kept with its own run time, so a request that is seen again leaves the result alone, a result
    waits for its request, and a document that was read before or is older than what is held changes nothing.
    """
    landed = {}
    for endpoint, documents in given.items():
        ledger = wh.path(f"_progress/{endpoint}")
        if full_refresh:
            delete_path(wh.spark, ledger)
        elif "landing_file" in documents.columns and exists(wh.spark, ledger):
            documents = documents.join(wh.read(f"_progress/{endpoint}", "landing_file string"), "landing_file", "left_anti")
        landed[endpoint] = stage(documents, f"landed-{endpoint}")
        checked(quality.check_landing(landed[endpoint], endpoint))
    halves = {e: flat(landed[e]) for e, flat in (("reports_enqueue", flat_requests), ("reports_result", flat_results)) if e in landed}
    _take_up(wh, halves, stores, full_refresh, checked)
    # Last, so that a build that stops before is repeated with the same documents.
    for endpoint, documents in landed.items():
        if "landing_file" in documents.columns:
            write_table(documents.select("landing_file").distinct(), wh.path(f"_progress/{endpoint}"), mode="append")


def take_up_reports(wh: Warehouse, halves: dict[str, DataFrame], stores: DataFrame | None = None) -> DataFrame:
    """Renew the report rows of all jobs in `halves`, which has flat requests, flat results or both by endpoint.

    For documents that did not come through `build`, such as those of a stream.  Returns the results of the checks.
    """
    results: list[DataFrame] = []

    def checked(found: DataFrame) -> None:
        found = stage(found, "checks")
        quality.enforce(found)
        results.append(found)

    with scratch_scope(wh.spark):
        _take_up(wh, halves, stores, False, checked)
        found = _union(results)
        return wh.spark.createDataFrame(found.collect(), found.schema)


def _take_up(wh: Warehouse, given: dict[str, DataFrame], stores: DataFrame | None, full_refresh: bool, checked) -> None:
    tables = wh.report_halves()

    def held(endpoint: str) -> DataFrame:
        table, schema = tables[endpoint]
        return table.read(schema=schema)

    halves = {}
    for endpoint, rows in given.items():
        _, schema = tables[endpoint]
        before = wh.spark.createDataFrame([], schema) if full_refresh else held(endpoint)
        halves[endpoint] = stage(newer_half(before, stage(rows.select(schema.names), f"flat-{endpoint}")).select(schema.names), f"new-{endpoint}")
    jobs = stage(_union([h.select("job_id") for h in halves.values()]).distinct(), "changed-jobs")

    def known(endpoint: str) -> DataFrame:
        """The halves of the jobs that change, from now or from before."""
        new = halves.get(endpoint)
        if full_refresh:
            return held(endpoint) if new is None else new
        of_jobs = held(endpoint).join(jobs, "job_id", "left_semi")
        return of_jobs if new is None else of_jobs.join(new, "job_id", "left_anti").unionByName(new)

    requests, tz = _zoned(wh, known("reports_enqueue"), stores, "path_merchant_id")
    reports = stage(report_rows(requests, known("reports_result"), tz), "reports")
    # Before anything is kept, so that documents a check refuses leave no trace.
    checked(quality.check_silver_reports(reports))
    touched = reports
    if not full_refresh and exists(wh.spark, wh.path("silver_reports")):
        table = wh.read("silver_reports", SILVER_REPORTS)
        # Only jobs that differ change the table; the others would rewrite their partitions.
        reports = stage(reports.exceptAll(table.select(reports.columns)), "changed-reports")
        # The day that a job leaves changes, too.
        left = table.join(reports.select("job_id"), "job_id", "left_semi")
        touched = reports.select("merchant_id", "report_date").unionByName(left.select("merchant_id", "report_date"))
    _log_change(wh, touched.select("merchant_id", F.trunc("report_date", "month").alias("target_month")).distinct())
    _save(wh, "silver_reports", reports, ["job_id"], ["merchant_id"], full_refresh)
    for endpoint, half in halves.items():
        table, _ = tables[endpoint]
        if full_refresh:
            table.replace(half)
        else:
            table.upsert(half)
            table.fold()
            table.drop_old(keep=2)


def _log_change(wh: Warehouse, rows: DataFrame) -> None:
    """Write down what is about to change: orders (by key and month) or months of a merchant."""
    if "order_id" not in rows.columns:
        rows = rows.withColumns({"order_id": F.lit(None).cast("string"), "source_marketplace": F.lit(None).cast("string")})
    write_table(rows.select(*ORDER_KEY, "target_month"), f"{wh.path('_changes')}/batch={uuid.uuid4().hex}")


def _pending(wh: Warehouse, model: str, full_refresh: bool):
    """The logged changes that `model` has not taken up (None: everything), and how to note that it has."""
    changes = wh.path("_changes")
    schema = "order_id string, source_marketplace string, merchant_id string, target_month date, batch string"
    rows = wh.spark.createDataFrame([], schema)
    if exists(wh.spark, changes):
        rows = wh.spark.read.schema(schema).parquet(changes)
    batches = stage(rows.select("batch").distinct(), "batches")
    taken = wh.path(f"_progress/{model}")

    def done() -> None:
        write_table(batches, taken)

    if full_refresh or not exists(wh.spark, wh.path(model)) or not exists(wh.spark, taken):
        return None, done
    before = wh.spark.read.schema("batch string").parquet(taken)
    # Staged, so that noting it down later cannot change what is read here.
    return stage(rows.join(batches, "batch", "left_semi").join(before, "batch", "left_anti"), "pending"), done


def _served(wh: Warehouse, silver: DataFrame, costs: DataFrame, months: DataFrame | None) -> DataFrame:
    """Sales with order totals split over their lines and each day's payout and variance split over its lines.

    Only the given months of merchants, each of them whole: a payout belongs to a day.
    """
    lines = silver.withColumn("target_month", F.trunc("target_date", "month"))
    reports = None
    if exists(wh.spark, wh.path("silver_reports")):
        reports = wh.read("silver_reports", SILVER_REPORTS).withColumn("target_month", F.trunc("report_date", "month"))
    else:
        reports = wh.spark.createDataFrame([], SILVER_REPORTS).withColumn("target_month", F.trunc("report_date", "month"))
    if months is not None:
        lines, reports = (x.join(months, MONTH, "left_semi") for x in (lines, reports))
    lines = stage(lines, "served-lines")
    recon = settlement_reconciliation(order_headers(lines), reports, wh.rate, day="target_date")
    fact = allocated_fact(lines, costs, wh.rate, keep=("target_date", "target_month"))
    return fact_with_settlement(fact, recon, day="target_date")


def save_costs(wh: Warehouse, edits: DataFrame) -> None:
    """Save a batch of cost edits to the ledger and recompute the margins of what they touch.

    `edits` has the ledger's columns, in major units; the last edit of a (merchant, SKU) wins.
    """
    with scratch_scope(wh.spark), shuffles_deleted(wh.spark):
        _save_costs(wh, stage(last_edits(edits), "cost-edits"))


def _save_costs(wh: Warehouse, edits: DataFrame) -> None:
    merge_replace(wh.path("merchant_cogs"), edits, ITEM_KEY, ["merchant_id"], keys_move=False, settled=True)
    silver, ledger = wh.read("silver_orders", SILVER_ORDERS), cogs_in_minor_units(wh.read("merchant_cogs", COGS_LEDGER))
    affected = recompute_affected(silver, ledger, edits, wh.rate, keep=("target_date",))
    merge_replace(
        wh.path("fact_financial_sales"), wh.laid_out(affected, "target_date"), [*ORDER_KEY, "line_item_no"],
        list(wh.order_partitions), keys_move=False)
    # The served sales take the new costs up with the next build.
    sold = silver.join(edits.select(*ITEM_KEY), ITEM_KEY, "left_semi")
    _log_change(wh, sold.select("merchant_id", F.trunc("target_date", "month").alias("target_month")).distinct())


def _zoned(
    wh: Warehouse, df: DataFrame, stores: DataFrame | None, merchant: str
) -> tuple[DataFrame, str | Column]:
    """`df` with its merchants' time zones, and the zone to use."""
    if stores is None:
        return df, wh.tz
    # One zone for each merchant, whatever the list holds.
    zones = stores.groupBy(F.col("merchant_id").alias(merchant)).agg(F.min("store_tz").alias("store_tz"))
    return df.join(zones, merchant, "left"), F.coalesce("store_tz", F.lit(wh.tz))


def _save(
    wh: Warehouse, model: str, rows: DataFrame, keys: list[str], partitions: list[str], full_refresh: bool,
    clear: DataFrame | None = None,
) -> None:
    """Merge staged `rows` into the model's table, or replace it."""
    if full_refresh:
        replace_table(rows, wh.path(model), partitions)
    else:
        merge_replace(wh.path(model), rows, keys, partitions, evolve=True, clear=clear, settled=True)


def _union(results: list[DataFrame]) -> DataFrame:
    if not results:
        raise ValueError("nothing to build: the selected models have no input")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
