"""Column expressions. Everything here stays inside generated JVM code."""

from epitally.functions.dates import (
    axis_label,
    in_period,
    month_start,
    parse_day_month_year,
    parse_leading_date,
    period_label,
    with_date_parts,
)
from epitally.functions.measures import incidence, mask_zero, null_propagating_sum, round_half_away, sum_or_zero
from epitally.functions.predicates import is_in, not_in
from epitally.functions.recode import classify, decimal_comma, id_prefix, map_region, recode, unify_spelling

__all__ = [
    "axis_label",
    "classify",
    "decimal_comma",
    "id_prefix",
    "in_period",
    "incidence",
    "is_in",
    "map_region",
    "mask_zero",
    "month_start",
    "not_in",
    "null_propagating_sum",
    "parse_day_month_year",
    "parse_leading_date",
    "period_label",
    "recode",
    "round_half_away",
    "sum_or_zero",
    "unify_spelling",
    "with_date_parts",
]
