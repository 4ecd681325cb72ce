"""Short forms for building and reading small frames."""

import datetime as dt


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    """Rows as tuples, in a fixed order that copes with NULL."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def table(df, key):
    """Rows by key, as dictionaries."""
    return {row[key]: row.asDict() for row in df.collect()}
