"""Command line: run the daily gold job.

    spark-submit critiq/cli.py \\
        --feed google_play=/lake/silver/reviews/store_a \\
        --feed internal_database_mongodb=/lake/silver/reviews/internal \\
        --feed apple_store=/lake/silver/reviews/store_b \\
        --target /lake/gold/reviews --run-date 20250510 [--env pre]

``--env pre`` prints the first rows of every feed, of the deduplicated rows
and of the gold rollup (the original job's pre-production mode); ``pro``
prints nothing. ``--odate-from`` / ``--odate-to`` restrict the feeds to a
range of load dates (partition pruning); by default the whole history is
read, as in the original job.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
from datetime import datetime

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from critiq.plans.pipeline import PipelineConfig, PipelineResult, Targets, run_pipeline  # noqa: E402
from critiq.plans.report import RunInfo, failure_report  # noqa: E402
from critiq.sources.feeds import DEFAULT_FEEDS, read_feed  # noqa: E402
from critiq.sources.sinks import append_report  # noqa: E402

PREVIEW_ROWS = {"pre": 5, "pro": 0}


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="critiq", description="Daily review gold job")
    p.add_argument("--feed", action="append", required=True, metavar="NAME=PATH",
                   help="a feed by its spec name and Parquet base path (repeatable)")
    p.add_argument("--target", required=True, help="base path of the published outputs")
    p.add_argument("--run-date", default=datetime.now().strftime("%Y%m%d"), help="load date YYYYMMDD")
    p.add_argument("--env", choices=sorted(PREVIEW_ROWS), default="pro")
    p.add_argument("--odate-from")
    p.add_argument("--odate-to")
    p.add_argument("--job", default="gold_aggregate")
    p.add_argument("--original-names", action="store_true", help="publish gold under the original column names")
    p.add_argument("--survivors", metavar="PATH",
                   help="keep one row per id of all runs here, and give only new days as feeds")
    args = p.parse_args(argv)
    known = {s.name for s in DEFAULT_FEEDS}
    feeds = {}
    for item in args.feed:
        name, sep, path = item.partition("=")
        if not sep or not path:
            p.error(f"--feed expects NAME=PATH, got {item!r}")
        if name not in known:
            p.error(f"unknown feed {name!r}; known: {sorted(known)}")
        feeds[name] = path
    args.feeds = feeds
    return args


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> PipelineResult:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = spark or SparkSession.builder.appName("critiq gold job").getOrCreate()
    targets = Targets.under(args.target)
    run = RunInfo(application_id=spark.sparkContext.applicationId, job=args.job)
    try:
        feeds = {
            name: read_feed(spark, path, odate_from=args.odate_from, odate_to=args.odate_to)
            for name, path in args.feeds.items()
        }
    except Exception as exc:
        # A feed that cannot be opened fails the run like any later step: report it.
        append_report(failure_report(spark, exc, run), targets.failures, "failure", f"{run.application_id}:{args.run_date}")
        raise
    cfg = PipelineConfig(
        targets=targets,
        run_date=args.run_date,
        run=run,
        feeds=tuple(s for s in DEFAULT_FEEDS if s.name in feeds),
        preview_rows=PREVIEW_ROWS[args.env],
        original_gold_names=args.original_names,
        survivors=args.survivors,
    )
    result = run_pipeline(spark, feeds, cfg)
    for v in result.verdicts:
        print(f"{v['check']}: {'PASS' if v['status'] else 'FAIL'} ({v['code']}) {v['message']}")
    for name, rows in result.preview.items():
        print(f"-- {name}: {result.schemas.get(name, '')}")
        for row in rows:
            print("   ", row)
    print(json.dumps({"summary": result.summary.asDict(), "type_client": result.type_client, "seconds": result.seconds}))
    return result


if __name__ == "__main__":
    try:
        main()
    except Exception:  # noqa: BLE001 - exit code for the scheduler; the report is already written
        logging.exception("gold job failed")
        sys.exit(1)
