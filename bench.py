"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed in full through the ``noop`` sink (no result
collection cost); the median of $BENCH_REPEAT runs counts. No plan or file is reused between
runs: ``scan_feeds`` lays the feeds out on disk each time, as timed apart in ``landing_write``.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from critiq.plans.pipeline import PipelineConfig, Targets, run_pipeline  # noqa: E402
from critiq.plans.queries import RUN, RUN_DATE, queries  # noqa: E402
from critiq.session import build_session, scratch_path  # noqa: E402
from critiq.sources.testbed import DATA_LEXICON, derived_feeds, write_landing_zone  # noqa: E402

HEADLINE = (
    "gold_rollup",
    "pipeline_gold",
    "dedup_by_key",
    "quality_verdicts",
    "invalid_rows_with_dups",
    "history_view",
    "lexicon_flags",
    "scan_feeds",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="critiq-bench")
    registry = queries()

    # Warm the JVM (class loading, codegen caches) on the smallest scale.
    run(registry["gold_rollup"](spark, "/root/testdata/sf0.001"))

    timings: dict[str, float] = {}
    for name in HEADLINE:
        seconds = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(registry[name](spark, sf_dir))
            seconds.append(time.perf_counter() - t0)
        timings[name] = round(median(seconds), 3)

    # What of scan_feeds is the writing of its input.
    t0 = time.perf_counter()
    write_landing_zone(spark, sf_dir, scratch_path(spark, "bench-landing"))
    landing = round(time.perf_counter() - t0, 3)

    # One more daily run: its Spark jobs (AQE submits one per query stage) and
    # the wall seconds of its steps.
    sc = spark.sparkContext
    sc.setJobGroup("critiq-pipeline-count", "one pipeline run", False)
    cfg = PipelineConfig(
        targets=Targets.under(scratch_path(spark, "bench-pipeline")),
        run_date=RUN_DATE,
        run=RUN,
        lexicon=DATA_LEXICON,
    )
    steps = run_pipeline(spark, derived_feeds(spark, sf_dir), cfg).seconds
    pipeline_jobs = len(sc.statusTracker().getJobIdsForGroup("critiq-pipeline-count"))
    sc.setLocalProperty("spark.jobGroup.id", None)

    sf = os.path.basename(sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf[2:] if sf.startswith("sf") else sf,
                "cpus": cpus,
                "landing_write_sec": landing,
                "pipeline_spark_jobs": pipeline_jobs,
                "pipeline_steps_sec": steps,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
