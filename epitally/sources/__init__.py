"""Reading inputs and writing results."""

from epitally.sources.dimensions import add_labels, period_codes, read_area_map, read_population, resolve_region_columns
from epitally.sources.files import (
    detect_separator,
    first_column_like,
    modification_times,
    normalize_columns,
    read_events,
    read_texts,
    source_modified,
    write_table,
)

__all__ = [
    "add_labels",
    "detect_separator",
    "first_column_like",
    "modification_times",
    "normalize_columns",
    "period_codes",
    "read_area_map",
    "read_events",
    "read_population",
    "read_texts",
    "resolve_region_columns",
    "source_modified",
    "write_table",
]
