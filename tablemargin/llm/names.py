"""Names for columns that an operator adds for itself."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def unused(taken: DataFrame | Iterable[str], *wanted: str) -> list[str]:
    """Each wanted name, with underscores added until no column has it (names compare without case)."""
    have = {c.lower() for c in (taken.columns if isinstance(taken, DataFrame) else taken)}
    out = []
    for name in wanted:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out
