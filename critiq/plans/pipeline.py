"""The daily gold job: feeds -> unified -> dedup -> checks -> gold and views.

Spark jobs per run (the original job triggered 24 actions, each re-reading
every feed):

0. row count of each feed (its files' footers); an all-empty input stops the run here;
1. union + dedup, written once as a Parquet stage table in the shared
   folder (``spark.checkpoint.dir``). While it is written, ``observe``
   gathers every quality count from the deduplicated
   rows: the metrics sit after the shuffle, in the write's result stage,
   whose accumulator updates Spark applies once per partition, so they stay
   exact when tasks are retried. The stage table cuts the lineage, survives
   lost executors, and later jobs read only the columns they need from it;
   it is removed when the run ends. The distinct segments come from it by a grouped aggregate;
2. gold rollup -> Parquet, then 3. gold documents (read back from the gold
   Parquet, not recomputed);  4. invalid rows -> Parquet;  5. history view
   documents. These three branches only read the stage table, so they are
   submitted from parallel driver threads and Spark runs their jobs side by
   side;  6. run report append.

Only one-row results (metrics, verdicts) reach the driver.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from critiq.functions.sql import string_literal
from critiq.functions.text import DEFAULT_LEXICON, Lexicon
from critiq.operators.dedup import dedup_by_key
from critiq.operators.harmonize import harmonize_all
from critiq.operators.survivors import BUCKETS, SurvivorStore
from critiq.operators.quality import (
    VALID_SQL,
    quality_summary,
    summary_aggregates,
    summary_frame,
    summary_of_unique_keys,
    validate_ingest,
    verdicts,
)
from critiq.operators.rollup import consolidate, display_order, gold_rollup, preview, with_original_names
from critiq.operators.views import history_view
from critiq.plans.report import RunInfo, failure_report, run_report, segment_list
from critiq.schema import ORIGINAL_GOLD_NAMES, UNIFIED_SCHEMA
from critiq.session import remove_path, scratch_path
from critiq.sources.feeds import DEFAULT_FEEDS, FeedSpec, feed_row_counts, read_feed, require_rows
from critiq.sources.sinks import append_report, read_partitioned_parquet, write_documents, write_partitioned_parquet

log = logging.getLogger(__name__)

# The stage table lives for one run: free-text columns skip the dictionary
# encoding attempt (their values rarely repeat, so Parquet would fall back).
STAGE_WRITE_OPTIONS = {
    "parquet.enable.dictionary#title": "false",
    "parquet.enable.dictionary#snippet": "false",
}


@dataclass(frozen=True)
class Validation:
    """Result of ``validate``: all lazy DataFrames (nothing runs until used)."""

    valid: DataFrame
    invalid: DataFrame
    verdicts: DataFrame
    summary: DataFrame


def load_reviews(
    spark: SparkSession,
    paths: Mapping[str, str],
    feeds: tuple[FeedSpec, ...] = DEFAULT_FEEDS,
    odate_from: str | None = None,
    odate_to: str | None = None,
) -> DataFrame:
    """Read the feeds at ``paths`` (keyed by spec name), harmonize, union and
    keep one row per id: the unified, deduplicated review rows (lazy)."""
    frames = {name: read_feed(spark, path, odate_from=odate_from, odate_to=odate_to) for name, path in paths.items()}
    order = [s.name for s in feeds]
    return dedup_by_key(harmonize_all(frames, feeds), priority=order)


def validate(df: DataFrame, run_date: str, strict: bool = False) -> Validation:
    """The three checks and the valid / invalid split of unified rows, lazily:
    ``verdicts`` and ``summary`` come from one aggregation job when used."""
    summary = quality_summary(df, strict=strict)
    valid, invalid = validate_ingest(df, run_date, strict=strict)
    return Validation(valid=valid, invalid=invalid, verdicts=verdicts(summary), summary=summary)


@dataclass(frozen=True)
class Targets:
    """Where a run publishes."""

    gold: str
    invalid: str
    gold_documents: str
    history_documents: str
    report: str
    failures: str

    @classmethod
    def under(cls, base: str) -> "Targets":
        base = base.rstrip("/")
        return cls(
            gold=f"{base}/gold",
            invalid=f"{base}/invalid",
            gold_documents=f"{base}/documents/gold_view",
            history_documents=f"{base}/documents/history_view",
            report=f"{base}/report/success",
            failures=f"{base}/report/failure",
        )


@dataclass(frozen=True)
class PipelineConfig:
    targets: Targets
    run_date: str
    run: RunInfo
    lexicon: Lexicon = DEFAULT_LEXICON
    feeds: tuple[FeedSpec, ...] = DEFAULT_FEEDS
    preview_rows: int = 0
    # False keeps the original split (a row whose only NULL is the snippet is
    # in neither output); True sends such rows to the invalid output.
    strict_validity: bool = False
    # Publish gold (Parquet and documents) under the original job's column
    # names, for consumers of its output.
    original_gold_names: bool = False
    # Publish gold, invalid rows and history documents from parallel driver
    # threads (independent jobs over the stage table).
    parallel_outputs: bool = True
    # Folder of a ``SurvivorStore``: the feeds are merged into it, instead of being
    # the whole history, and the outputs are of all that it then holds.
    survivors: str | None = None
    survivor_buckets: int = BUCKETS  # of a store that is new


@dataclass
class PipelineResult:
    rows_by_source: dict[str, int]  # of each feed as read
    kept_by_source: dict[str, int]  # after dedup
    summary: Row
    verdicts: list[Row]
    type_client: str
    wrote_gold: bool
    wrote_invalid: bool
    report: Row
    # First rows (``preview_rows`` > 0) and schemas of each feed, of the
    # deduplicated rows and of the gold rollup in display order.
    preview: dict[str, list[Row]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def _run_side_by_side(spark: SparkSession, parallel: bool, *actions):
    """Run independent Spark actions, each from its own driver thread when
    ``parallel`` (Spark schedules their jobs together); results in order.

    The threads inherit the caller's local properties (job group, scheduler
    pool), so cancelling or accounting the caller's group covers their jobs.
    The first error is raised after all actions have ended.
    """
    if not parallel:
        return [a() for a in actions]
    results: list = [None] * len(actions)
    errors: list = [None] * len(actions)

    def runner(i: int) -> None:
        try:
            results[i] = actions[i]()
        except BaseException as exc:  # noqa: BLE001 - re-raised below
            errors[i] = exc

    threads = [InheritableThread(target=runner, args=(i,)) for i in range(len(actions))]
    for th in threads:
        th.start()
    for th in threads:
        th.join()
    for exc in errors:
        if exc is not None:
            raise exc
    return results


@contextmanager
def _step(seconds: dict[str, float], name: str):
    t0 = time.perf_counter()
    try:
        yield
    finally:
        seconds[name] = round(time.perf_counter() - t0, 3)


def run_pipeline(spark: SparkSession, feeds: Mapping[str, DataFrame], cfg: PipelineConfig) -> PipelineResult:
    """Run the whole job over ``feeds`` (raw feed frames keyed by spec name)."""
    run = cfg.run
    sec: dict[str, float] = {}
    shown: dict[str, list[Row]] = {}
    schemas = {name: df.schema.simpleString() for name, df in feeds.items()}
    n_preview = cfg.preview_rows
    run_key = f"{run.application_id}:{cfg.run_date}"
    stage = None
    try:
        unified = harmonize_all(feeds, cfg.feeds)
        if n_preview > 0:
            with _step(sec, "preview_feeds"):
                shown.update({name: df.limit(n_preview).collect() for name, df in feeds.items()})
        names = [s.name for s in cfg.feeds]
        with _step(sec, "feed_counts"):
            by_source = require_rows(feed_row_counts({x: feeds[x] for x in names}))
        with _step(sec, "dedup_stage"):
            measures = [
                *summary_aggregates(cfg.strict_validity),
                *[F.expr(f"count_if(app_source = {string_literal(x)}) AS `source:{x}`") for x in names],
            ]
            if cfg.survivors is None:
                metrics = Observation("quality")
                stage = scratch_path(spark, f"stage-{cfg.run_date}")
                staged = dedup_by_key(unified, priority=names).observe(metrics, *measures)
                staged.write.mode("overwrite").options(**STAGE_WRITE_OPTIONS).parquet(stage)
                observed = metrics.get
                deduped = spark.read.schema(UNIFIED_SCHEMA).parquet(stage)
            else:  # the feeds are the new days; what earlier runs have kept is in the store
                store = SurvivorStore(spark, cfg.survivors, cfg.survivor_buckets)
                store.merge(unified, names)
                deduped = store.read()
                observed = deduped.agg(*measures).first().asDict()
        summary = summary_of_unique_keys(observed)
        kept = {x: int(observed[f"source:{x}"]) for x in names}
        schemas["deduplicated"] = deduped.schema.simpleString()
        if n_preview > 0:
            shown["deduplicated"] = deduped.limit(n_preview).collect()
        with _step(sec, "segments"):
            type_client = segment_list(deduped.where(VALID_SQL)).collect()[0]["type_client"]
        verdict_rows = verdicts(summary_frame(spark, summary)).collect()
        log.info("validation of %d records", summary["total_records"])
        for v in verdict_rows:
            log.info("%s: %s (%d) %s", v["check"], "PASS" if v["status"] else "FAIL", v["code"], v["message"])
        valid, invalid = validate_ingest(deduped, cfg.run_date, summary, strict=cfg.strict_validity)

        t = cfg.targets

        def publish_gold() -> bool:
            with _step(sec, "gold"):
                gold = gold_rollup(consolidate(valid), cfg.lexicon)
                names = ORIGINAL_GOLD_NAMES if cfg.original_gold_names else None
                if cfg.original_gold_names:
                    gold = with_original_names(gold)
                # Sorted within each output file only: no global sort (range shuffle) for display order.
                wrote = write_partitioned_parquet(
                    gold, t.gold, cfg.run_date, "valid", empty=summary["n_valid"] == 0, order=display_order(names)
                )
            with _step(sec, "gold_documents"):
                if wrote:
                    published = (
                        read_partitioned_parquet(spark, t.gold, schema=gold.schema)
                        .where(F.col("odate") == cfg.run_date)
                        .drop("odate")
                    )
                    write_documents(published, t.gold_documents, empty=False)
                    schemas["gold"] = published.schema.simpleString()
                    if n_preview > 0:
                        shown["gold"] = preview(published, n_preview, names).collect()
            return wrote

        def publish_invalid() -> bool:
            with _step(sec, "invalid"):
                return write_partitioned_parquet(
                    invalid, t.invalid, cfg.run_date, "invalid", empty=summary["n_invalid"] == 0
                )

        def publish_history() -> bool:
            with _step(sec, "history_documents"):
                history = history_view(valid)
                return write_documents(history, t.history_documents, empty=summary["n_valid"] == 0)

        # The three outputs only read the stage table: their jobs run side by
        # side, so one job's narrow final stage does not leave the cluster idle.
        with _step(sec, "publish"):
            wrote_gold, wrote_invalid, _ = _run_side_by_side(
                spark, cfg.parallel_outputs, publish_gold, publish_invalid, publish_history
            )

        with _step(sec, "report"):
            done = replace(run, end=run.end or datetime.now(), timestamp=run.timestamp or datetime.now())
            report = run_report(spark, summary, verdict_rows, type_client, done, steps=dict(sec))
            append_report(report, t.report, "success", run_key)
        return PipelineResult(
            rows_by_source=by_source,
            kept_by_source=kept,
            summary=summary,
            verdicts=verdict_rows,
            type_client=type_client,
            wrote_gold=wrote_gold,
            wrote_invalid=wrote_invalid,
            report=report.collect()[0],
            preview=shown,
            schemas=schemas,
            seconds=sec,
        )
    except Exception as exc:
        log.error("gold job failed: %s", exc)
        try:
            append_report(failure_report(spark, exc, cfg.run, df=None), cfg.targets.failures, "failure", run_key)
        except Exception as report_exc:  # noqa: BLE001 - keep the original error
            log.error("failure report not written: %s", report_exc)
        raise
    finally:
        if stage is not None:
            remove_path(spark, stage)
