"""High-water marks and latest-run selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the mark used before anything was loaded.
EPOCH = "1900-01-01 00:00:00"


def high_water_mark(df: DataFrame, column: str, default: str = EPOCH, per: list[str] | None = None) -> DataFrame:
    """max(column) as `high_water_mark`, one row, or one row per `per` group."""
    mark = F.coalesce(F.max(column), F.lit(default).cast("timestamp_ntz")).alias("high_water_mark")
    return df.groupBy(*(per or [])).agg(mark)


def incremental_filter(
    source: DataFrame, target: DataFrame, column: str, per: list[str] | None = None, default: str = EPOCH
) -> DataFrame:
    """Source rows newer than what the target already holds.

    Without `per` one mark covers every tenant, so a tenant that lags behind another loses rows;
    `per=["merchant_id"]` keeps a mark per tenant.  Rows with a NULL in `column` are not newer.
    """
    marks = high_water_mark(target, column, default, per)
    if not per:
        return source.where(F.col(column) > marks.scalar())
    floor = F.lit(default).cast("timestamp_ntz")
    joined = source.join(marks, per, "left")
    return joined.where(F.col(column) > F.coalesce("high_water_mark", floor)).drop("high_water_mark")


def latest_run_wins(df: DataFrame, keys: list[str], run_column: str) -> DataFrame:
    """Rows of each key's latest run, all of them when that run holds several.

    The latest run per key is a partially aggregated max that is joined back, instead of a window:
    a key with very many rows is combined before the shuffle and its join can be split.  The join
    is on the grouping keys alone, so both sides share one partitioning.  `df` is read twice; if
    it is costly to compute, stage it first.  A row with a NULL key is compared with nothing and kept.
    """
    latest = df.groupBy(*keys).agg(F.max(run_column).alias("_latest"))
    is_latest = F.col("_latest").isNull() | (F.col(run_column) >= F.col("_latest"))
    return df.join(latest, keys, "left").where(is_latest).select(*df.columns)


def superseded_keys(df: DataFrame, keys: list[str], run_column: str) -> DataFrame:
    """Keys with rows that `latest_run_wins` leaves out, prefixed with `_`, and their `_latest` run; from few columns of `df`."""
    runs = df.groupBy(*keys).agg(F.max(run_column).alias("_latest"), F.min(run_column).alias("_least"),
                                 F.count(run_column).alias("_dated"), F.count(F.lit(1)).alias("_rows"))
    several = runs.where(F.col("_latest").isNotNull() & ((F.col("_least") < F.col("_latest")) | (F.col("_dated") < F.col("_rows"))))
    return several.dropna(subset=keys).select(*[F.col(k).alias(f"_{k}") for k in keys], "_latest")


def without_superseded(df: DataFrame, superseded: DataFrame, keys: list[str], run_column: str) -> DataFrame:
    """What `latest_run_wins` gives, by the staged `superseded_keys`: where they are few, no whole row is shuffled."""
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_{k}") for k in keys])
    older = F.col(run_column).isNull() | (F.col(run_column) < F.col("_latest"))
    return df.join(superseded, same & older, "left_anti")


def latest_row(df: DataFrame, keys: list[str], run_column: str) -> DataFrame:
    """Exactly one row per key, from its latest run; equal runs are ordered by the other columns.

    One partially aggregated max of the whole row, for rows that are small: no join is needed.
    """
    others = [c for c in df.columns if c not in keys and c != run_column]
    latest = df.groupBy(*keys).agg(F.max(F.struct(run_column, *others)).alias("_row"))
    return latest.select(*keys, "_row.*").select(*df.columns)


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with a NULL in any key column."""
    return df.dropna(subset=keys)
