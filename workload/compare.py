"""Compare registered queries with their SQL twins in DuckDB.

python -m workload.compare [sf_dir] [name prefix...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

from cartwright.session import build_session

from .queries import ORACLES, QUERIES


def canonical(value) -> str:
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (Decimal, float, int)):
        return f"{float(value):.6f}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def sorted_rows(names, rows):
    """Rows in canonical text, columns by name, in sorted order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


# What DuckDB calls the column types that Spark produces here.
TYPE_NAMES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def differences(spark, con, sf_dir: str, name: str) -> tuple[int, list[str]]:
    """(rows, what differs): schema first, then values."""
    df = QUERIES[name](spark, sf_dir)
    got = sorted_rows(df.columns, df.collect())
    if name not in ORACLES:
        return len(got), []
    cursor = con.execute(ORACLES[name])
    theirs = {c[0]: str(c[1]) for c in cursor.description}
    ours = {n: TYPE_NAMES.get(t, t.upper()) for n, t in df.dtypes}
    found = [] if ours == theirs else [f"schema {sorted(set(ours.items()) ^ set(theirs.items()))}"]
    want = sorted_rows(list(theirs), cursor.fetchall())
    if len(got) != len(want):
        found.append(f"{len(got)} rows, not {len(want)}")
    if got != want:
        mine, other = set(got), set(want)
        found.append(f"only here {sorted(mine - other)[:3]}, only in SQL {sorted(other - mine)[:3]}")
    return len(got), found


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = tuple(sys.argv[2:])
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session(master="local[8]", conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in QUERIES:
        if only and not name.startswith(only):
            continue
        started = time.time()
        try:
            rows, found = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            rows, found = -1, [str(error)[:600]]
        bad += bool(found)
        print(
            "DIFF" if found else "ok" if name in ORACLES else "rows",
            name, rows, f"{time.time() - started:.1f}s", *found, flush=True,
        )
    print("differing queries:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
