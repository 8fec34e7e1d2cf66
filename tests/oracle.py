"""Compare registered queries with their SQL: python tests/oracle.py [sf folder] [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    """Rows with their columns in name order, sorted, numbers by value."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return round(float(v), 9) if isinstance(v, float) and math.isfinite(v) else v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, name: str, query, sql: str, folder: str) -> list[str]:
    found = query(spark, folder)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(found.columns) != sorted(columns):
        return [f"{name}: columns {found.columns} and {columns}"]
    left = _rows(found.columns, [tuple(r) for r in found.collect()])
    right = _rows(columns, result.fetchall())
    if len(left) != len(right):
        return [f"{name}: {len(left)} rows and {len(right)}"]
    return [f"{name}: {a} and {b}" for a, b in zip(left, right) if a != b][:3]


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from bench import session

    folder = sys.argv[1] if len(sys.argv) > 1 else str(TESTDATA / "sf0.01")
    spark, con, sqls = session(), connect(folder), entry.oracle_sql()
    wanted = sys.argv[2:] or list(sqls)
    for name in wanted:
        start = time.time()
        problems = differences(spark, con, name, entry.queries()[name], sqls[name], folder)
        print(name, "DIFFERS" if problems else "equal", f"{time.time() - start:.1f}s", *problems, sep="\t", flush=True)
