"""Comparison of a query with its SQL on the same tables: `python -m tests.compare [sf] [name ...]`."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if hasattr(value, "item"):
        return plain(value.item())
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, x or "") for x in t)
    )


def oracle_rows(sql: str, folder: str):
    import duckdb

    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    return columns, result.fetchall(), types


def difference(spark, name: str, sf: str) -> str | None:
    """What differs between the query and its SQL, or None."""
    import __spark_entry__ as entry

    folder = f"{TESTDATA}/sf{sf}"
    df = entry.queries()[name](spark, folder)
    got_columns, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None
    columns, rows, types = oracle_rows(sql, folder)
    want_columns, want = canonical(columns, rows)
    if got_columns != want_columns:
        return f"columns {set(got_columns) ^ set(want_columns)}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    odd = {c: (kinds[c], t) for c, t in types.items() if (kinds[c], t.lower()) not in SAME_TYPES}
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(c, a, b) for c, a, b in zip(got_columns, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows, first: {cells}"
    return None


SAME_TYPES = {
    ("string", "varchar"),
    ("string", "string"),
    ("bigint", "bigint"),
    ("int", "integer"),
    ("double", "double"),
    ("date", "date"),
    ("timestamp_ntz", "timestamp"),
    ("timestamp_ntz", "datetime"),
    ("boolean", "boolean"),
    ("boolean", "bool"),
}


def main() -> int:
    import __spark_entry__ as entry
    from dayledger.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = difference(spark, name, sf)
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        state = "ok" if found is None else "BAD"
        failed += found is not None
        mark = "" if name in entry.oracle_sql() else " (rows only)"
        print(f"{state:4}{name}{mark} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} as expected at sf{sf}")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
