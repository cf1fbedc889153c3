"""Run every query on Spark and its SQL on DuckDB and compare the rows.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from txnlake.session import local_session  # noqa: E402

TABLES = ("events", "lineitem", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def rows_of(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([(columns[i], row[i]) for i in order]) for row in rows)


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return duck


def compare(spark, duck, sf_dir: str, name: str) -> tuple[bool, str]:
    start = time.time()
    df = queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    found = duck.sql(oracle_sql()[name])
    want = rows_of(found.columns, found.fetchall())
    note = f"{name:28} {len(got):7} rows {took:6.2f}s"
    if got == want:
        return True, note
    extra = sorted(set(got) - set(want))[:2]
    lacking = sorted(set(want) - set(got))[:2]
    return False, f"{note} want {len(want)}\n  extra   {extra}\n  lacking {lacking}"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session(8)
    connection = duck_connection(sf)
    for query in sys.argv[2:] or list(oracle_sql()):
        try:
            same, text = compare(session, connection, sf, query)
            print("ok  " if same else "DIFF", text, flush=True)
        except Exception as e:  # noqa: BLE001 - report and go on
            print("FAIL", query, str(e)[:1500], flush=True)
