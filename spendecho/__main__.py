"""python -m spendecho run --landing DIR --cache DIR [...]

Runs the whole flow from landed CSV files to exported marts. `--enricher
package.module:function` names the batch function for unseen texts; without it
the cache is replayed only.
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
from datetime import datetime, timezone

from .plans.pipeline import Run, Settings, run_pipeline
from .session import build_session
from .sources.tables import export_marts


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="spendecho", description=__doc__)
    parser.add_argument("step", choices=["run", "load", "enrich", "export"])
    parser.add_argument("--landing", required=True, help="folder with the CSV files")
    parser.add_argument("--cache", required=True, help="folder of the enrichment cache")
    parser.add_argument("--model", default="default", help="model version to prefer")
    bronze = parser.add_mutually_exclusive_group()
    bronze.add_argument("--truncate", action="store_true", default=None, help="replace Bronze (what run does)")
    bronze.add_argument("--append", action="store_false", dest="truncate", help="append to Bronze (what load does)")
    parser.add_argument("--enricher", help="module:function for unseen texts; none replays the cache")
    parser.add_argument("--batch-size", type=int, default=100)
    parser.add_argument("--rounds", type=int, help="checkpointed slices of the unseen texts; else by their number")
    parser.add_argument("--limit", type=int, help="enrich only the first rows by id")
    parser.add_argument("--sample", type=int, default=0, help="print some enriched rows")
    parser.add_argument("--no-cache-write", action="store_true")
    parser.add_argument("--buckets", type=int, help="by feedback_id, 0 for none; else by the bytes landed")
    parser.add_argument("--prefix", default="", help="prefix of the four databases")
    parser.add_argument("--export", help="folder for the Parquet exports")
    return parser.parse_args(argv)


def settings_of(args: argparse.Namespace) -> Settings:
    enricher = None
    if args.enricher:
        module, _, function = args.enricher.partition(":")
        enricher = getattr(importlib.import_module(module), function)
    return Settings(
        landing_dir=args.landing, cache_path=args.cache, model=args.model,
        run_ts=datetime.now(timezone.utc).replace(tzinfo=None), prefix=args.prefix,
        truncate=args.truncate, enricher=enricher, batch_size=args.batch_size, rounds=args.rounds,
        limit=args.limit, keep_cache=not args.no_cache_write, buckets=args.buckets,
        export_dir=args.export,
    )


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session("spendecho", os.environ.get("SPARK_MASTER"))
    settings = settings_of(args)
    run = Run(spark, settings)
    if args.step == "run":
        result = run_pipeline(spark, settings)
    elif args.step == "load":
        result = run.load()
    elif args.step == "enrich":
        result = run.enrich()
    else:
        result = export_marts(spark, run.db["marts"], args.export)
    print(json.dumps(result))
    if args.sample:
        run.table("raw", "feedback_enriched").orderBy("feedback_id").limit(args.sample).show()


if __name__ == "__main__":
    main()
