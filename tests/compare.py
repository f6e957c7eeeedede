"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        path = Path(directory) / f"{table}.parquet"
        if path.exists():
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def difference(spark_df, db, sql) -> str | None:
    """None when the two agree, else the first difference."""
    left_names, left = rows_of(spark_df.columns, spark_df.collect())
    result = db.execute(sql)
    right_names, right = rows_of([d[0] for d in result.description], result.fetchall())
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(left_names, a, b) if x != y]
            return f"cells {cells} in {a}"
    return None


def main(directory: str, *chosen: str) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark, db, failed = make_session(), connect(directory), 0
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            df = run(spark, directory)
            if name in oracles:
                problem = difference(df, db, oracles[name])
                state = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                problem, state = None, f"rows only: {len(df.collect())}"
        except Exception as error:  # report every query, then fail
            problem = state = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {state}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
