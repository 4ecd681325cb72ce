"""Recoding and classification of text columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lookup(col: Column, mapping: Mapping[str, str]) -> Column:
    """Value for a key of a small fixed mapping, else NULL; evaluates ``col`` once."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = F.create_map(*(F.lit(text) for pair in mapping.items() for text in pair))
    return F.try_element_at(pairs, col)


def recode(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace exact values; everything else, NULL included, stays."""
    return F.coalesce(_lookup(col, mapping), col)


def map_region(col: Column, mapping: Mapping[str, str], default: str | None = "keep") -> Column:
    """Region short name for a code or a full name; unknown ones kept or NULL."""
    if default not in ("keep", None):
        raise ValueError("default must be 'keep' or None")
    return recode(col, mapping) if default == "keep" else _lookup(col, mapping)


def classify(rules: Iterable[tuple[str, Iterable[str], str]], otherwise: Column) -> Column:
    """Label of the first rule ``(column, values, label)`` that matches, else ``otherwise``.

    Successive rules on one column are one lookup, so that a column that is
    costly to compute is computed once and not once per rule.
    """
    lookups = []
    for column, group in groupby(rules, key=lambda rule: rule[0]):
        labels: dict[str, str] = {}
        for _, values, label in group:
            for value in values:
                labels.setdefault(value, label)
        lookups.append(_lookup(F.col(column), labels))
    return F.coalesce(*lookups, otherwise)


def unify_spelling(col: Column, pattern: str, replacement: str, only_with: str | None = None) -> Column:
    """Regex substitution; ``only_with`` is a text that every match contains, and spares other rows the regex."""
    replaced = F.regexp_replace(col, pattern, replacement)
    return replaced if only_with is None else F.when(col.contains(only_with), replaced).otherwise(col)


def id_prefix(col: Column) -> Column:
    """Text before the first slash; the whole text when there is none."""
    return F.substring_index(col, "/", 1)


def decimal_comma(col: Column, data_type: str = "double") -> Column:
    """Number written as ``1.234,5``; NULL when it is not one, or has a fraction where a whole one is asked for."""
    plain = F.replace(F.replace(F.trim(col), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    if data_type == "double":
        return plain.try_cast(data_type)
    number = plain.try_cast("decimal(38,9)")
    return F.when(number == F.floor(number), number.try_cast(data_type))
