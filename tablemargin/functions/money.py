"""Cent-exact money columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Fixed value: the marketplace commission charged when a merchant has no other rate.
COMMISSION_RATE = Decimal("0.15")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def commission(gross: Column | str, rate: Decimal | str = COMMISSION_RATE) -> Column:
    """round(gross * rate) in minor units, halves away from zero.

    The rate is a ratio of two integers, so the whole expression is BIGINT arithmetic inside
    codegen; a decimal product of this width would fall back to BigDecimal objects per row.
    """
    num, den = Decimal(str(rate)).as_integer_ratio()
    g = _col(gross).cast("bigint")
    half = F.when(g < 0, F.lit(-den)).otherwise(F.lit(den)).cast("bigint")
    return F.call_function("div", g * F.lit(2 * num).cast("bigint") + half, F.lit(2 * den).cast("bigint"))


def percent_tenths(part: Column, whole: Column) -> Column:
    """100 * part / whole rounded to one decimal; 0.0 where whole is not positive.

    Rounds in integer arithmetic (halves away from zero) so no binary fraction is involved.
    """
    p, w = part.cast("decimal(25,0)"), whole.cast("decimal(25,0)")
    tenths = F.call_function("div", F.abs(p) * F.lit(Decimal(2000)) + w, w * F.lit(Decimal(2)))
    return F.when(whole > 0, F.when(part < 0, -tenths).otherwise(tenths) / F.lit(10.0)).when(
        whole.isNotNull(), F.lit(0.0))


def tidy_currency(c: Column | str) -> Column:
    """Upper-cased and trimmed, whether or not it is a code then: checks tell."""
    return F.upper(F.trim(_col(c)))


def normalize_currency(c: Column | str) -> Column:
    """Upper-cased, trimmed ISO code; NULL when it is not three letters."""
    code = tidy_currency(c)
    return F.when(code.rlike("^[A-Z]{3}$"), code)


def to_minor_units(major: Column | str) -> Column:
    """Major units (3.50) to BIGINT minor units (350)."""
    return F.round(_col(major).cast("decimal(18,4)") * F.lit(Decimal(100)), 0).cast("bigint")
