"""Cent-exact pro-rata split of an amount over the rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablemargin.sources.tables import stage, stage_sized

#: Rows of a unit or group that one window sees, where they are numbered.
PAGE = 10_000
#: Bytes of staged rows for each partition of a range cut.
CUT_BYTES = 128 << 20


def allocate(
    df: DataFrame, amounts: dict[str, str], weight: str, group: list[str], order: list[str],
    unit: list[str] | None = None, page: str | None = None, place: str | None = None,
) -> DataFrame:
    """Split group amounts over the group's rows in proportion to `weight`.

    `amounts` maps each new column to the column holding the group's amount, which is the same
    on every row of the group.  Each part is the difference of two running floors of
    amount * weight so far / total weight, so the parts of a group sum to the amount exactly and
    none has the wrong sign.  A group whose weights are all zero is split evenly; a NULL amount
    gives NULL parts; negative or NULL weights count as zero.  The running sum follows `order`.
    `place` names a further new column for the row's number in that order.

    A group may hold any share of all rows, so no task ever sees a whole one.  Sums are chained on
    up to three levels, and the result does not depend on where the cuts fall:

    - `unit` names the first columns of `order` (an order in a merchant's day).  Units are summed to
      a row each, and only these rows are put in order within their group.
    - `page` names a number that ascends with the rest of `order` (a line number), by which a unit,
      or a group without units, is cut into pages of PAGE; a window sees one page.  Sums of
      earlier pages are looked up for those that have several.  Without units `df` is read again for
      that: stage it first if it is costly to compute.
    - What has no such number is cut by range into partitions of like size, and a table with a row
      for each group and partition chains their sums.
    """
    named = [*group, *(unit or [])]
    if unit and order[:len(unit)] != unit:
        raise ValueError("a unit's columns are the first ones of the order")
    weighted = df.withColumn("_w", F.greatest(F.coalesce(F.col(weight).cast("bigint"), _zero()), _zero()))
    if not unit and not page:
        staged, size = stage_sized(weighted.withColumn("_n", F.lit(1).cast("bigint")), "allocate")
        placed = _chained(staged, group, order, size).withColumns({"_upto_w": F.col("_w0") + F.col("_w"), "_upto_n": F.col("_n0") + 1})
    elif not unit:
        rows = _numbered(weighted, named, page)
        placed = _paged(rows, rows, order, page).withColumnsRenamed({"_unit_w": "_tw", "_unit_n": "_tn"})
    else:
        staged, size = stage_sized(weighted, "allocate")
        sums = staged.groupBy(*named).agg(F.sum("_w").alias("_w"), F.count(F.lit(1)).alias("_n"))
        units = _chained(sums, group, unit, size).select(F.struct(*named).alias("_unit"), "_w0", "_n0", "_tw", "_tn")
        rows = _numbered(staged, named, page)
        placed = _paged(rows.join(units, "_unit"), rows, order[len(unit):], page)
        placed = placed.withColumns({"_upto_w": F.col("_w0") + F.col("_upto_w"), "_upto_n": F.col("_n0") + F.col("_upto_n")})
    even = F.col("_tw") == 0
    own, run, total = (F.when(even, a).otherwise(b) for a, b in (
        (F.lit(1).cast("bigint"), F.col("_w")), (F.col("_upto_n"), F.col("_upto_w")), (F.col("_tn"), F.col("_tw"))))
    placed = placed.withColumns({"_own": own.cast("bigint"), "_run": run.cast("bigint"), "_total": total.cast("bigint")})
    shares = {}
    for name, amount in amounts.items():
        whole = F.abs(F.col(amount).cast("bigint"))
        upto = _floor_share(whole, F.col("_run"), F.col("_total"))
        below = _floor_share(whole, F.col("_run") - F.col("_own"), F.col("_total"))
        shares[name] = F.when(F.col(amount) < 0, below - upto).otherwise(upto - below)
    if place:
        shares[place] = F.col("_upto_n")
    return placed.withColumns(shares).select(*df.columns, *[c for c in shares if c not in df.columns])


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _numbered(df: DataFrame, unit: list[str], page: str | None) -> DataFrame:
    # A struct is never NULL itself and its NULL fields are equal, so a NULL key is one like others.
    number = F.floor(F.coalesce(F.col(page), _zero()) / PAGE) if page else F.lit(0).cast("bigint")
    return df.withColumns({"_unit": F.struct(*unit), "_page": number})


def _paged(df: DataFrame, rows: DataFrame, order: list[str], page_of: str | None) -> DataFrame:
    """`df` with the sums (`_upto_w`, `_upto_n`) of its unit up to and with each row, and the unit's totals.

    `rows` are the same rows before anything was joined to them.
    """
    page = Window.partitionBy("_unit", "_page")
    sofar = page.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumns({"_upto_w": F.sum("_w").over(sofar), "_upto_n": F.row_number().over(page.orderBy(*order)).cast("bigint"),
                          "_unit_w": F.sum("_w").over(page), "_unit_n": F.count(F.lit(1)).over(page)})
    # On the column itself, so that files whose statistics rule it out are not read.
    long = rows.where((F.col(page_of) >= PAGE) | (F.col(page_of) < 0)) if page_of else None
    if long is None or long.isEmpty():
        return out
    long = long.select("_unit").distinct()
    pages = rows.select("_unit", "_page", "_w").join(long, "_unit", "left_semi").groupBy("_unit", "_page").agg(
        F.sum("_w").alias("w"), F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy("_unit")
    earlier = every.orderBy("_page").rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.select("_unit", "_page", F.coalesce(F.sum("w").over(earlier), _zero()).alias("_before_w"),
                         F.coalesce(F.sum("n").over(earlier), _zero()).alias("_before_n"),
                         F.sum("w").over(every).alias("_whole_w"), F.sum("n").over(every).alias("_whole_n"))
    out = out.join(pages, ["_unit", "_page"], "left")
    return out.withColumns({
        "_upto_w": F.col("_upto_w") + F.coalesce("_before_w", _zero()), "_upto_n": F.col("_upto_n") + F.coalesce("_before_n", _zero()),
        "_unit_w": F.coalesce("_whole_w", "_unit_w"), "_unit_n": F.coalesce("_whole_n", "_unit_n")})


def _chained(df: DataFrame, group: list[str], order: list[str], size: int) -> DataFrame:
    """Rows (with `_w` and `_n`) and the sums of those before them in their group (`_w0`, `_n0`), and the group's totals.

    The rows are cut by range of (group, order) and written with their partition's number, which
    thus ascends with `order` inside a group; `size` bytes say how many partitions there are.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = stage(df.repartitionByRange(max(least, -(-size // CUT_BYTES)), *group, *order).withColumn("_part", F.spark_partition_id()), "allocate-cut")
    parts = cut.groupBy(*group, "_part").agg(F.sum("_w").alias("_pw"), F.sum("_n").alias("_pn"))
    every = Window.partitionBy(*group)
    earlier = every.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.struct(*group).alias("_group"), F.col("_part"),
        F.coalesce(F.sum("_pw").over(earlier), _zero()).alias("_w0"),
        F.coalesce(F.sum("_pn").over(earlier), _zero()).alias("_n0"),
        F.sum("_pw").over(every).alias("_tw"), F.sum("_pn").over(every).alias("_tn"))
    joined = cut.withColumn("_group", F.struct(*group)).join(offsets, ["_group", "_part"])
    before = Window.partitionBy("_group", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumns({f"_{x}0": F.col(f"_{x}0") + F.coalesce(F.sum(f"_{x}").over(before), _zero()) for x in ("w", "n")}).drop("_group", "_part")


def _floor_share(size: Column, running: Column, total: Column) -> Column:
    """floor(size * running / total); BIGINT arithmetic wherever the product surely fits."""
    fits = size.cast("double") * total.cast("double") < 4e18
    wide = size.cast("decimal(19,0)") * running.cast("decimal(19,0)")
    return F.when(fits, F.call_function("div", size * running, total)).otherwise(
        F.call_function("div", wide, total.cast("decimal(19,0)")))
