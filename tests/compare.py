"""Run registered queries beside their SQL in DuckDB and report differences.

    python tests/compare.py SF_DIR [QUERY ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(0.0 if value == 0 else value)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(frame, sql: str, connection) -> str | None:
    """None when both sides hold the same rows under the same names."""
    ours = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}"
    unlike = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if unlike:
        return f"{len(unlike)} rows differ, first {str(unlike[0][0])[:300]} against {str(unlike[0][1])[:300]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as driver
    from conftest import new_session

    spark, connection = new_session(), connect(sf_dir)
    oracles, failed = driver.oracle_sql(), 0
    for name, query in driver.queries().items():
        if names and name not in names:
            continue
        started = time.perf_counter()
        try:
            if name in oracles:
                problem = difference(query(spark, sf_dir), oracles[name], connection)
            else:
                problem = None if query(spark, sf_dir).collect() else "no rows"
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:26s} {time.perf_counter() - started:6.2f}s {problem or 'same'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    sys.exit(main(sys.argv[1], sys.argv[2:]))
