"""Dates, months and report periods."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.config import Report


_MARK = r"\s*[-/. _,]\s*"


def _digits(year: str) -> str:
    """Day, month and year apart by marks (groups 1 to 3), or two digits each and nothing between (4 to 6)."""
    return rf"\s*(?:([0-9]{{1,2}}){_MARK}([0-9]{{1,2}}){_MARK}({year})|([0-9]{{2}})([0-9]{{2}})({year}))\s*"


_ISO = "$3$6-$2$5-$1$4"
_NAMED = r"^\s*([0-9]{1,2})[-/. _,\s]*([a-z]+)[-/. _,\s]*([0-9]{4}|[0-9]{2})\s*$"

#: Spellings of the twelve months, in English and Dutch.
MONTH_NAMES = (
    ("jan", "january", "januari"),
    ("feb", "february", "februari"),
    ("mar", "mrt", "march", "maart"),
    ("apr", "april"),
    ("may", "mei"),
    ("jun", "june", "juni"),
    ("jul", "july", "juli"),
    ("aug", "august", "augustus"),
    ("sep", "sept", "september"),
    ("oct", "okt", "october", "oktober"),
    ("nov", "november"),
    ("dec", "december"),
)


def _rearranged(col: Column, shape: str, iso: str) -> Column:
    """Text of the given shape, put in ISO order; any other text comes back with a mark in front.

    One regex per row. Unlike a date pattern, neither it nor the cast that follows
    raises an internal exception for text that does not fit, which would cost more
    than the parse. The mark keeps other text from being taken for a date.
    """
    return F.regexp_replace(F.concat(F.lit("~"), col), f"^~{shape}$", iso)


def _with_century(iso: Column) -> Column:
    """Two digits up to 68 are this century."""
    return F.concat(F.when(iso < "69", "20").otherwise("19"), iso)


def parse_day_month_year(col: Column, month_names: Sequence[Sequence[str]] = MONTH_NAMES) -> Column:
    """Day-month-year text with any usual separator, or none, two- or four-digit
    year, month number or name, and any white space around it. NULL when it is not a date.

    Each further shape is only tried on rows that are not a date yet.
    """
    low = F.lower(col)
    names = F.create_map(*(F.lit(x) for i, spellings in enumerate(month_names, 1) for name in spellings for x in (name, f"{i:02}")))
    year = F.regexp_extract(low, _NAMED, 3)
    month = F.try_element_at(names, F.regexp_extract(low, _NAMED, 2))
    iso = F.concat(year, F.lit("-"), month, F.lit("-"), F.regexp_extract(low, _NAMED, 1))
    return F.coalesce(
        _rearranged(col, _digits("[0-9]{4}"), _ISO).try_cast("date"),
        F.when(
            col.rlike("[A-Za-z]"), F.when(F.length(year) == 2, _with_century(iso)).otherwise(iso).try_cast("date")
        ).otherwise(_with_century(_rearranged(col, _digits("[0-9]{2}"), _ISO)).try_cast("date")),
    )


def parse_leading_date(col: Column) -> Column:
    """``dd/mm/yyyy`` at the start of the text; whatever follows is ignored."""
    # Padding makes a short year a valid one: 20 is the year 20.
    return _rearranged(col, r"\s*([0-9]{1,2})/([0-9]{1,2})/([0-9]{1,4})[\s\S]*", "000$3-$2-$1").try_cast("date")


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def with_date_parts(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    return df.withColumns(
        {
            "year": F.year(date_col),
            "month": F.month(date_col),
            "quarter": F.quarter(date_col),
        }
    )


def period_label(date: Column, report: Report) -> Column:
    """``2001`` in a yearly report, ``2001_Q2`` in a quarterly one."""
    year = F.year(date).cast("string")
    return year if report.yearly else F.concat(year, F.lit("_Q"), F.quarter(date).cast("string"))


def in_period(date: Column, year: int, report: Report) -> Column:
    """Whether a date lies in the report period of ``year``; a plain range test."""
    first = datetime.date(year, report.first_month, 1)
    return (date >= first) & (date < report.window_end(first))


def axis_label(date: Column) -> Column:
    """Month name; January carries the year on a second line."""
    return F.when(F.month(date) == 1, F.date_format(date, "MMM\nyyyy")).otherwise(F.date_format(date, "MMM"))
