"""Command line: ``python -m stratalake STEP --root FOLDER ...``.

Steps: ``load-pharmacy``, ``load-events``, ``load-tables``, ``build-models`` and
``refresh``, which is all of them in order. Run it with ``spark-submit`` on a
cluster.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from stratalake import Lake, build_session
from stratalake.plans import (
    Source, audit_frame, build_models, load_changed_table, load_event_pages, load_pharmacy_drops, publish_views, refresh,
)
from stratalake.schemas import CHANGED_TABLES, TABLES
from stratalake.sources import jdbc_table

STEPS = ("load-pharmacy", "load-events", "load-tables", "build-models", "refresh")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stratalake", description=__doc__)
    p.add_argument("step", choices=STEPS)
    p.add_argument("--root", required=True, help="folder of the lake's tables")
    p.add_argument("--drops", help="folder of CSV drops")
    p.add_argument("--pages", help="folder of landed event pages")
    p.add_argument("--table", action="append", default=[], metavar="NAME=WHERE",
                   help="an operational table: a Parquet folder or a jdbc: URL; once per table")
    p.add_argument("--jdbc-schema", default="dbo")
    p.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--full", action="store_true", help="load from the beginning, set the watermarks anew and build all models anew")
    p.add_argument("--views", action="store_true", help="publish SQL views at the end")
    return p


def opener(spark: SparkSession, name: str, where: str, schema: str, options: dict[str, str]) -> Source:
    if not where.startswith("jdbc:"):
        return spark.read.parquet(where)

    def open_since(since: str) -> DataFrame:
        until = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        return jdbc_table(spark, TABLES[name], where, f"{schema}.{name}", since, until, **options)

    return open_since


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Run the step; the result is its audit, one row per load."""
    lake = Lake(spark, args.root)
    options = dict(o.split("=", 1) for o in args.jdbc_option)
    tables = {n: opener(spark, n, w, args.jdbc_schema, options) for n, w in (t.split("=", 1) for t in args.table)}
    steps: dict[str, Callable[[], list]] = {
        "load-pharmacy": lambda: [load_pharmacy_drops(lake, args.drops)],
        "load-events": lambda: [load_event_pages(lake, args.pages, args.full)],
        "load-tables": lambda: [
            load_changed_table(lake, s, tables[s.name], args.full) for s in CHANGED_TABLES if s.name in tables
        ],
        "build-models": lambda: build_models(lake, args.full) and [],
        "refresh": lambda: refresh(lake, args.drops, args.pages, tables, args.full),
    }
    audits = steps[args.step]()
    if args.views:
        publish_views(lake)
    return audit_frame(spark, audits)


def main() -> None:
    logging.basicConfig(level="INFO", format="%(name)s: %(message)s")
    args = parser().parse_args()
    run(build_session("stratalake"), args).show(truncate=False)


if __name__ == "__main__":
    main()
