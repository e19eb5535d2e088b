"""Named queries over the shared tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablemargin.plans.shared_tables import SharedTables, sql_with
from tablemargin.session import own_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(select: str | None = None, needs: tuple[str, ...] = ()) -> Callable:
    """Register a function of `SharedTables` under its name; `select` is its SQL counterpart."""
    def register(fn: Callable[[SharedTables], DataFrame]) -> Callable[[SharedTables], DataFrame]:
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(SharedTables(own_session(spark), sf_dir))
        if select is not None:
            ORACLES[fn.__name__] = sql_with(list(needs), select)
        return fn
    return register


def load() -> None:
    """Import every module that registers queries."""
    from tablemargin.plans.queries import (  # noqa: F401
        days, gates, landing, lines, mutation, quality, reconciliation, report_state, runs, sales, sql_functions, variants, versions)
