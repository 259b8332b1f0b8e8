"""Compare registered queries with their SQL in DuckDB.

    python tools/compare.py [FOLDER] [NAME …]

Columns are sorted by name and rows as text, so order does not matter.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from gates import ORACLES, QUERIES  # noqa: E402
from gates.registry import TABLES  # noqa: E402
from tablewright import build_session  # noqa: E402


def connect(folder: str):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, db, name: str, folder: str) -> list[str]:
    """What differs between a query and its SQL; empty when they agree."""
    df = QUERIES[name](spark, folder)
    columns, rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return []
    relation = db.sql(ORACLES[name])
    other_columns, other_rows = _rows(relation.columns, relation.fetchall())
    found = []
    if columns != other_columns:
        found.append(f"columns {columns} != {other_columns}")
    if len(rows) != len(other_rows):
        found.append(f"{len(rows)} rows != {len(other_rows)}")
    ours, theirs = Counter(rows), Counter(other_rows)
    only, other_only = list((ours - theirs).elements()), list((theirs - ours).elements())
    if only or other_only:
        found.append(f"{len(only)} rows differ: {only[:2]} | {other_only[:2]}"[:1500])
    spark_types = dict(df.dtypes)
    types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    }
    odd = {c: (t, types.get(c)) for c, t in spark_types.items() if names.get(t, t) != types.get(c)}
    if odd:
        found.append(f"types {odd}")
    return found


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        "compare",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_driver_memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(folder), 0
    for name in names or QUERIES:
        start = time.perf_counter()
        try:
            found = differences(spark, db, name, folder)
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [f"{type(error).__name__}: {str(error)[:1200]}"]
        failed += bool(found)
        mark = "ok  " if not found else "FAIL"
        weak = "" if name in ORACLES else " (no SQL)"
        print(f"{mark} {name}{weak} {time.perf_counter() - start:.2f}s", *found, flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    where = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    raise SystemExit(main(where, arguments) > 0)
