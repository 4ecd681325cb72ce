"""Numbers written as text, with the marks that a whole column of an export uses.

``1,234`` and ``12.0``, or ``1.234`` and ``12,0``: the separator of a file makes one
way of writing the usual one. A column is read the other way only if more of its
values can be read so, which one aggregation over the export counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.sources.schemas import InputColumn

NUMERIC = ("int", "bigint", "double")

#: Texts that stand for a missing value.
MISSING = ("", "NA")


def usual_mark(sep: str) -> str:
    """The decimal mark of files with this separator."""
    return "," if sep == ";" else "."


def _form(mark: str) -> str:
    group = "," if mark == "." else r"\."
    mark = r"\." if mark == "." else ","
    power = "([eE][+-]?[0-9]+)?"
    return rf"^\s*[+-]?([0-9]+|[0-9]{{1,3}}({group}[0-9]{{3}})+)({mark}[0-9]*)?{power}\s*$|^\s*[+-]?{mark}[0-9]+{power}\s*$"


def _plain(text: Column, mark: str) -> Column:
    """The text with a decimal point and without grouping marks; NULL if it is no number."""
    trimmed = F.trim(text)
    plain = F.replace(trimmed, F.lit(","), F.lit("")) if mark == "." else F.translate(trimmed, ",.", ".")
    return F.when(text.rlike(_form(mark)), plain)


def number(text: Column, data_type: str, mark: str) -> Column:
    """NULL for what is not a number, or has a fraction where a whole one is asked for."""
    plain = _plain(text, mark)
    if data_type == "double":
        return plain.try_cast(data_type)
    exact = plain.try_cast("decimal(38,9)")
    return F.when(exact == F.floor(exact), exact.try_cast(data_type))


def reject_reason(text: Column, data_type: str, mark: str) -> Column:
    """Why a text gives no number; NULL if it gives one or is missing."""
    plain = _plain(text, mark)
    exact = plain.try_cast("decimal(38,9)")
    reason = F.when(plain.isNull(), "not a number")
    if data_type != "double":
        reason = reason.when(exact.isNotNull() & (exact != F.floor(exact)), "not whole")
    reason = reason.when(number(text, data_type, mark).isNull(), "too large")
    return F.when(text.isNotNull() & ~F.trim(text).isin(*MISSING), reason)


def column_marks(parts: Sequence[tuple[DataFrame, str]], schema: Sequence[InputColumn]) -> list[dict[str, str]]:
    """For each (texts, separator) the decimal mark of each numeric column, by name; one job for all of them."""
    wanted = [c for c in schema if c.data_type in NUMERIC]
    marks = [{c.name: usual_mark(sep) for c in wanted} for _, sep in parts]
    if not wanted or not parts:
        return marks
    forms = [F.count_if(F.col(f"n{k}").rlike(_form(mark))).alias(f"{name}{k}") for k in range(len(wanted)) for name, mark in (("point", "."), ("comma", ","))]
    texts = None
    for i, (raw, _) in enumerate(parts):
        own = raw.select(F.lit(i).alias("part"), *(F.col(f"`{c.header}`").alias(f"n{k}") for k, c in enumerate(wanted)))
        texts = own if texts is None else texts.unionByName(own)
    for row in texts.groupBy("part").agg(*forms).collect():
        for k, c in enumerate(wanted):
            point, comma = row[f"point{k}"], row[f"comma{k}"]
            if point != comma:
                marks[row.part][c.name] = "." if point > comma else ","
    return marks
