"""Run registered queries against their SQL oracle and report differences.

usage: python tests/oracle_check.py <sf_dir> [query ...]
"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows_of(table: pa.Table) -> tuple[list[tuple], list[tuple]]:
    names = sorted(table.column_names)
    columns = [table[n].to_pylist() for n in names]
    kinds = [(n, _kind(table.schema.field(n).type)) for n in names]
    return kinds, sorted(zip(*columns), key=repr)


def _kind(data_type: pa.DataType) -> str:
    text = str(data_type)
    return "timestamp" if text.startswith("timestamp") else text.replace("large_", "")


def difference(spark_table: pa.Table, duck_table: pa.Table) -> str | None:
    """None when both hold the same rows under the same column names and types."""
    spark_kinds, spark_rows = rows_of(spark_table)
    duck_kinds, duck_rows = rows_of(duck_table)
    if spark_kinds != duck_kinds:
        return f"columns differ: {sorted(set(spark_kinds) ^ set(duck_kinds))}"
    if len(spark_rows) != len(duck_rows):
        return f"row counts differ: {len(spark_rows)} and {len(duck_rows)}"
    wrong = [(a, b) for a, b in zip(spark_rows, duck_rows) if repr(a) != repr(b)]
    if wrong:
        a, b = wrong[0]
        return f"{len(wrong)} of {len(spark_rows)} rows differ, first:\n  spark {a}\n  duck  {b}"
    return None


def main() -> int:
    from conftest import build_session

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, connection, failed = build_session(), duck(sf_dir), 0
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            result = function(spark, sf_dir).toArrow()
            seconds = time.time() - start
            sql = entry.oracle_sql().get(name)
            problem = difference(result, connection.sql(sql).to_arrow_table()) if sql else None
            note = "" if sql else "(no oracle)"
        except Exception:
            problem, seconds, note, result = traceback.format_exc(limit=3)[-1500:], 0, "", []
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {len(result)} rows {seconds:.1f}s {note}", flush=True)
        if problem:
            print(problem, flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
