"""Column -> Column expressions with the reference's non-standard semantics.

Everything here is a native Spark expression (no Python UDF), so it stays
inside whole-stage codegen.
"""

from almanac.functions.text import (  # noqa: F401
    title_case, not_in_keep_null, replace_map, replace_substrings, zero_pad,
    squash_spaces, normalize_name,
)
from almanac.functions.numeric import (  # noqa: F401
    parse_numeric, sentinel_to_null, sentinel_to_zero, strict_sum,
    asymmetric_sum, coverage_average, coverage_week_total, half_even,
    cents, from_cents, from_units, money_sum, to_units, total,
)
from almanac.functions.dates import (  # noqa: F401
    week_end_monday, epoch_ms_to_date, run_date, vintage_of, date_shift,
    parse_date,
)
