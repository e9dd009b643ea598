"""Run queries next to their SQL: ``python -m conformance.check SF_DIR [NAME ...]``."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

from conformance.queries import ORACLE, QUERIES
from stratalake import build_session

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        return value.normalize() + 0
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def normalised(names: list[str], rows) -> list[tuple]:
    """Columns by name and rows in a fixed order."""
    at = [names.index(n) for n in sorted(names)]
    return sorted((tuple(_plain(r[i]) for i in at) for r in rows), key=repr)


def compare(spark, db, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = normalised(df.columns, df.collect())
    took = time.time() - started
    cursor = db.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    want = normalised(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        lacking = [r for r in want if r not in set(got)][:2]
        return False, f"{len(got)} rows, expected {len(want)}; only here {extra}; only there {lacking}"
    return True, f"{len(got)} rows, {took:.1f} s"


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session("conformance", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failed = 0
    for name in names:
        try:
            ok, note = compare(spark, db, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
