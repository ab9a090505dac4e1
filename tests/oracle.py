"""Compare registered queries with their DuckDB definitions.

    python -m tests.oracle [scale factor] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


_SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    return compare(df.dtypes, [tuple(r) for r in df.collect()], con, sql)


def compare(dtypes, rows, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    result = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(list(expected_types), result.fetchall())
    actual_types = {n: _SPARK_TYPES.get(t, t) for n, t in dtypes}
    actual = rows_of([n for n, _ in dtypes], rows)
    if sorted(actual_types) != sorted(expected_types):
        return f"columns {sorted(actual_types)} != {sorted(expected_types)}"
    if actual != expected:
        extra = [r for r in actual if r not in set(expected)][:2]
        lost = [r for r in expected if r not in set(actual)][:2]
        return f"{len(actual)} rows vs {len(expected)}; only Spark {extra}; only SQL {lost}"
    types = {c: (t, expected_types[c]) for c, t in actual_types.items() if t != expected_types[c]}
    return f"types {types}" if types else None


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, sqls, failed = make_session(), connection(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if len(argv) > 1 and name not in argv[1:]:
            continue
        started, rows, built, middle = time.time(), [], 0.0, 0.0
        try:
            df = run(spark, sf_dir)
            built = time.time() - started
            rows = [tuple(r) for r in df.collect()]
            middle = time.time() - started
            problem = compare(df.dtypes, rows, con, sqls[name]) if name in sqls else "rows only"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem not in (None, "rows only")
        total = time.time() - started
        times = f"build {built:5.1f} spark {middle:6.2f} sql {total - middle:6.2f}"
        print(f"{name:26} {times} {len(rows):6} {problem or 'ok'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
