"""String expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanac.functions.util import col_of


def title_case(c) -> Column:
    """Python ``str.title``: upper-case after *any* non-letter, lower the rest.

    ``initcap`` only splits on spaces (``miami-dade`` -> ``Miami-dade``), so
    the string is split into letter / non-letter runs and each run is
    ``initcap``-ed; a non-letter run is unchanged by ``initcap``.
    """
    c = col_of(c)
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, lambda x: F.initcap(x)), "")


def not_in_keep_null(c, values: Iterable) -> Column:
    """``~isin`` as pandas does it: a null key passes the filter."""
    c = col_of(c)
    values = list(values)
    if not values:
        return F.lit(True)
    return c.isNull() | ~c.isin(values)


def replace_map(c, mapping: Mapping) -> Column:
    """``Series.replace(dict)`` on one column: mapped values change, others stay."""
    c = col_of(c)
    if not mapping:
        return c
    expr = None
    for k, v in mapping.items():
        cond = c.isNull() if k is None else (c == F.lit(k))
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(c)


def replace_substrings(c, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal (non-regex) substring replacements applied in order."""
    c = col_of(c)
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def squash_spaces(c) -> Column:
    """Remove every blank (``str.replace(" ", "")``)."""
    return F.replace(col_of(c), F.lit(" "), F.lit(""))


def normalize_name(c) -> Column:
    """Lower case, blanks removed."""
    return F.lower(squash_spaces(c))


def zero_pad(c, width: int = 5) -> Column:
    """``str.zfill(width)``: zeros go in front (behind a sign); a longer value
    stays as it is (``lpad`` would cut it)."""
    s = col_of(c).cast("string")
    sign = F.regexp_extract(s, "^[+-]", 0)
    zeros = F.repeat(F.lit("0"), F.greatest(F.lit(width) - F.length(s), F.lit(0)))
    return F.concat(sign, zeros, F.substring(s, F.length(sign) + 1, F.length(s)))
