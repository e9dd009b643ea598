"""``python -m stratalake.llm.check_sql SF_DIR NAME …``: queries next to their SQL."""

from __future__ import annotations

import sys

import duckdb

from stratalake import build_session
from stratalake.llm.queries import ORACLE, QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def main(sf_dir: str, *names: str) -> None:
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    for name in names or QUERIES:
        got = QUERIES[name](spark, sf_dir).toPandas()
        if name not in ORACLE:
            print(name, len(got), "rows, no SQL")
            continue
        want = con.execute(ORACLE[name]).df()
        columns = sorted(want.columns)
        same = sorted(got.columns) == columns and sorted(map(tuple, got[columns].values.tolist()), key=repr) == sorted(
            map(tuple, want[columns].values.tolist()), key=repr)
        print(name, len(got), len(want), "same" if same else "DIFFERENT")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
