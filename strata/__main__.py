"""Command line: ``python -m strata <command>``.

  build   run the daily build over a raw landing zone into the table store
  enrich  upsert a batch of captured API responses into raw/raw_tmdb_movies
  keys    print the next ids to enrich

The session is taken from the environment (``spark-submit`` settings); the store
root defaults to ``<spark.checkpoint.dir>/tables``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from strata.plans.build import build, enrich, keys_to_enrich
from strata.session import configure
from strata.sources.raw import from_parquet
from strata.sources.schemas import RAW_RESPONSES
from strata.sources.seeds import genre_mapping, read_seed_csv
from strata.sources.storage import TableStore


def _as_of(text: str | None) -> dt.datetime:
    return dt.datetime.fromisoformat(text) if text else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="strata")
    parser.add_argument("--store", help="table store root (default: <spark.checkpoint.dir>/tables)")
    sub = parser.add_subparsers(dest="command", required=True)

    b = sub.add_parser("build", help="daily build: seed, marts, incremental facts, checks, snapshots")
    b.add_argument("--raw", required=True, help="landing zone root with one Parquet folder per raw table")
    b.add_argument("--seed", help="genre mapping CSV on a shared file system (default: built-in seed)")
    b.add_argument("--as-of", help="snapshot time, ISO format (default: now, UTC)")
    b.add_argument("--on-duplicate", choices=["error", "latest"], default="error")
    b.add_argument("--order-col", help="raw arrival-order column, required with --on-duplicate latest")
    b.add_argument("--warn-only", action="store_true", help="report error-severity failures without failing")

    e = sub.add_parser("enrich", help="upsert captured API responses (Parquet: request_id, status, body, tmdb_id asked for)")
    e.add_argument("--responses", required=True)
    e.add_argument("--as-of", help="load time, ISO format (default: now, UTC)")

    k = sub.add_parser("keys", help="print the next ids to enrich")
    k.add_argument("--batch-size", type=int, default=100)

    args = parser.parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"strata-{args.command}").getOrCreate())
    store = TableStore(spark, args.store)

    if args.command == "build":
        seed = read_seed_csv(spark, args.seed) if args.seed else genre_mapping(spark)
        result = build(
            spark, from_parquet(spark, args.raw, seed, args.order_col), store, _as_of(args.as_of),
            on_duplicate=args.on_duplicate, order_col=args.order_col, fail_on_error=not args.warn_only,
        )
        print(json.dumps({"versions": result.versions, "checks": result.report}, default=str))
    elif args.command == "enrich":
        responses = spark.read.schema(RAW_RESPONSES).parquet(args.responses)
        print(json.dumps(enrich(spark, store, responses, _as_of(args.as_of), order_col="request_id")))
    else:
        for row in keys_to_enrich(store, args.batch_size).toLocalIterator():
            print(row["tmdb_id"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
