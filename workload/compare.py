"""Run queries beside their SQL and compare schema, row count and values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        files = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{files}'")
    return con


def _plain(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime) and value.time() == dt.time():
        return value.date().isoformat()
    return str(value)


def _family(type_name: str) -> str:
    type_name = type_name.lower()
    for family, names in {
        "int": ("int", "bigint", "integer", "smallint"),
        "float": ("double", "float"),
        "text": ("string", "varchar"),
    }.items():
        if type_name in names:
            return family
    return type_name


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides agree exactly."""
    cursor = con.execute(sql)
    sql_types = {d[0]: _family(str(d[1])) for d in cursor.description}
    sql_rows = cursor.fetchall()
    df_types = {name: _family(kind) for name, kind in df.dtypes}
    if df_types != sql_types:
        both = set(df_types.items()) ^ set(sql_types.items())
        return [f"schema differs: {sorted(both)}"]
    order = sorted(df.columns)
    at = {d: i for i, d in enumerate(sql_types)}
    expected = sorted(tuple(_plain(row[at[c]]) for c in order) for row in sql_rows)
    actual = sorted(tuple(_plain(row[c]) for c in order) for row in df.collect())
    if len(actual) != len(expected):
        return [f"{len(actual)} rows, expected {len(expected)}"]
    return [f"{a} != {e}" for a, e in zip(actual, expected) if a != e][:3]


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from epitally.session import local_session
    from workload.oracle import ORACLE
    from workload.queries import REGISTRY

    spark, con, bad = local_session(8), connect(folder), 0
    for name in names or REGISTRY:
        start = time.time()
        try:
            df: DataFrame = REGISTRY[name](spark, folder)
            found = differences(df, con, ORACLE[name]) if name in ORACLE else [f"no SQL; {df.count()} rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.2f}s", *found, sep="\n     " if found else " ")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(main(sys.argv[1], sys.argv[2:]))
