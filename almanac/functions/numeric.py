"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanac.functions.util import col_of

# Text markers the sources use for a suppressed or missing count.
SUPPRESSED_MARKERS = ("suppressed", "%null%")


def parse_numeric(c, errors: str = "raise") -> Column:
    """``pd.to_numeric(s.astype(str).str.replace(",", ""))``.

    Thousands separators are stripped; the text ``nan`` becomes null (pandas
    NaN, dropped later). ``errors="raise"`` keeps ANSI casting, so malformed
    text such as ``12x`` fails the job like pandas does; ``errors="null"``
    turns it into null instead.
    """
    s = F.trim(F.regexp_replace(col_of(c).cast("string"), ",", ""))
    is_nan = F.lower(s).isin("nan", "")
    parsed = s.cast("double") if errors == "raise" else s.try_cast("double")
    out = F.when(is_nan, F.lit(None).cast("double")).otherwise(parsed)
    return F.when(F.isnan(out), F.lit(None).cast("double")).otherwise(out)


def sentinel_to_null(c, min_exclusive: float = 0) -> Column:
    """Keep only values strictly above ``min_exclusive`` (``where(x > 0)``).

    With the default this nulls the ``-999999`` sentinel *and zero*.
    """
    c = col_of(c)
    return F.when(c > F.lit(min_exclusive), c)


def sentinel_to_zero(c, markers: Iterable[str] = SUPPRESSED_MARKERS) -> Column:
    """Text markers for suppressed values become ``"0"``; other text stays."""
    c = col_of(c)
    return F.when(c.isin(list(markers)), F.lit("0")).otherwise(c)


def strict_sum(*cols) -> Column:
    """``a + b + ...``: null if any operand is null."""
    out = col_of(cols[0])
    for c in cols[1:]:
        out = out + col_of(c)
    return out


def asymmetric_sum(a, b) -> Column:
    """``a + b.fillna(0)``: null only when the left operand is null."""
    return col_of(a) + F.coalesce(col_of(b), F.lit(0))


def coverage_average(total, coverage) -> Column:
    """``total / coverage``; a null or zero coverage gives null."""
    return F.try_divide(col_of(total), col_of(coverage))


def coverage_week_total(total, coverage, days: int = 7) -> Column:
    return coverage_average(total, coverage) * F.lit(days)


def half_even(c, scale: int = 0) -> Column:
    """numpy/pandas ``round``: ties to even (``bround``, not ``round``)."""
    return F.bround(col_of(c), scale)


def to_units(c, scale: int) -> Column:
    """A value of at most ``scale`` decimals as an exact integer count of its
    last decimal.

    Sums of units are exact and order-independent, and they run on plain
    64-bit integers (a decimal(18,2) sum widens to decimal(28,2), which
    Spark aggregates through arbitrary-precision objects). Only for sources
    whose values have that many decimals; others are summed as they are."""
    return F.round(col_of(c) * F.lit(10 ** scale)).cast("bigint")


def from_units(c, scale: int) -> Column:
    """Back to a double: one correctly rounded division, i.e. the double
    nearest the exact value."""
    return col_of(c) / F.lit(float(10 ** scale))


def total(c, scale: int | None = None) -> Column:
    """Sum of the values as they are, or, where the source states how many
    decimals its values have, the exact sum at that ``scale``."""
    return F.sum(col_of(c)) if scale is None else from_units(F.sum(to_units(c, scale)), scale)


def cents(c) -> Column:
    """Two-decimal amount as an integer count of hundredths."""
    return to_units(c, 2)


def from_cents(c) -> Column:
    return from_units(c, 2)


def money_sum(c) -> Column:
    """Exact, order-independent sum of two-decimal values, as double."""
    return total(c, 2)
