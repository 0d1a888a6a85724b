"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the shared test tables (through the feeds Spark derives
from them), so its work grows with the tables. Queries that exercise a
source or a sink first lay the feeds out on disk, or write their output,
under the shared checkpoint folder and read it back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from critiq.functions.casts import legacy_int, lenient_double
from critiq.functions.text import DEFAULT_LEXICON
from critiq.operators.dedup import dedup_by_key
from critiq.operators.harmonize import harmonize, harmonize_all
from critiq.operators.quality import (
    duplicate_keys,
    duplicate_rows,
    invalid_rows,
    non_numeric_ratings,
    null_counts,
    quality_summary,
    summary_frame,
    valid_rows,
    validate_ingest,
    verdicts,
)
from critiq.operators.rollup import consolidate, filter_period, gold_rollup, lexicon_flags, preview
from critiq.operators.survivors import SurvivorStore
from critiq.operators.views import history_projection, history_view
from critiq.plans.pipeline import PipelineConfig, Targets, run_pipeline
from critiq.plans.report import REPORT_SCHEMA, RunInfo, failure_report, rows_to_json, run_report, segment_list
from critiq.schema import UNIFIED_COLUMNS
from critiq.session import rename_children, scratch_path
from critiq.sources.feeds import (
    DEFAULT_FEEDS,
    INTERNAL_DB,
    STORE_A,
    STORE_A_APP_FROM_PATH,
    STORE_B,
    feed_row_counts,
    read_feed,
    read_feed_with_schema,
    with_provenance,
)
from critiq.sources.sinks import (
    append_report,
    documents_path,
    read_documents,
    read_partitioned_parquet,
    stamp_run_date,
    write_dated_parquet,
    write_documents,
    write_partitioned_parquet,
)
from critiq.sources.testbed import DATA_LEXICON, derived_feeds, load_date_of, write_landing_zone

Query = Callable[[SparkSession, str], DataFrame]

# Fixed run identity, so that report queries are reproducible.
RUN_DATE = "20240501"
RUN = RunInfo(
    application_id="run-0001",
    job="gold_aggregate",
    search="all_sources",
    team="data",
    project="reviews",
    layer="gold",
    start=datetime(2024, 5, 1, 6, 0, 0),
    end=datetime(2024, 5, 1, 6, 3, 30),
    timestamp=datetime(2024, 5, 1, 6, 3, 30),
)

GOLD_SCHEMA = T.StructType(
    [
        T.StructField("app_name", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("n_reviews", T.LongType()),
        T.StructField("n_positive", T.LongType()),
        T.StructField("n_negative", T.LongType()),
    ]
)

STORE_A_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("segmento", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("iso_date", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("snippet", T.StringType()),
        T.StructField("response", T.StringType()),
    ]
)


# -- shared inputs --------------------------------------------------------------
def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonize_all(derived_feeds(spark, sf_dir))


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_by_key(unified(spark, sf_dir))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(deduped(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_rollup(consolidate(valid(spark, sf_dir)), DATA_LEXICON)


def landing_zone(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The feeds laid out on disk."""
    return write_landing_zone(spark, sf_dir, scratch_path(spark, "landing"))


# -- sources ----------------------------------------------------------------------
def q_scan_feeds(spark, sf_dir):
    paths = landing_zone(spark, sf_dir)
    frames = [
        read_feed(spark, paths[s.name]).select(F.lit(s.name).alias("feed"), "id", "app", "segmento")
        for s in DEFAULT_FEEDS
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_scan_with_schema(spark, sf_dir):
    """Store A under ``googlePlay/<app>/odate=YYYYMMDD``: the app is in the path, but no partition column."""
    root = scratch_path(spark, "by_app") + "/googlePlay"
    feed = derived_feeds(spark, sf_dir)[STORE_A.name].withColumn("folder", F.coalesce("app", F.lit("none"))).drop("app")
    feed.withColumn("odate", load_date_of(STORE_A.name)).write.partitionBy("folder", "odate").parquet(root)
    rename_children(spark, root, "folder=", "")
    df = read_feed_with_schema(spark, STORE_A_SCHEMA, root, app_from_path=STORE_A_APP_FROM_PATH, recursive=True)
    return df.select("id", "app", "segmento", "rating", "iso_date", "title", "snippet")


def _provenance_union(spark, sf_dir, column):
    paths = landing_zone(spark, sf_dir)
    out = None
    for s in DEFAULT_FEEDS:
        f = with_provenance(read_feed(spark, paths[s.name]).drop("odate"))
        f = f.select(F.lit(s.name).alias("feed"), "id", column(f))
        out = f if out is None else out.unionByName(f)
    return out


def q_scan_provenance(spark, sf_dir):
    return _provenance_union(
        spark,
        sf_dir,
        lambda f: F.regexp_extract("file_name", r"([^/]+/odate=[0-9]{8})/[^/]+$", 1).alias("source_file"),
    )


def q_scan_load_date(spark, sf_dir):
    return _provenance_union(spark, sf_dir, lambda f: F.col("odate"))


def q_feed_row_counts(spark, sf_dir):
    paths = landing_zone(spark, sf_dir)
    return feed_row_counts({s.name: read_feed(spark, paths[s.name]) for s in DEFAULT_FEEDS})


# -- projections, union, dedup -----------------------------------------------
def _harmonized(spec):
    def q(spark, sf_dir):
        return harmonize(derived_feeds(spark, sf_dir)[spec.name], spec)

    return q


def q_rating_casts(spark, sf_dir):
    u = unified(spark, sf_dir)
    return u.select(
        "id",
        "app_source",
        "rating",
        legacy_int("rating").alias("rating_int"),
        lenient_double("rating").alias("rating_double"),
    )


# -- quality ------------------------------------------------------------------------
def q_invalid_rows(spark, sf_dir):
    return invalid_rows(deduped(spark, sf_dir))


def q_invalid_rows_with_dups(spark, sf_dir):
    _, inv = validate_ingest(unified(spark, sf_dir), RUN_DATE, summary=None)
    return inv


def q_stamp_run_date(spark, sf_dir):
    return stamp_run_date(valid(spark, sf_dir), RUN_DATE)


# -- rollup -------------------------------------------------------------------------
def q_consolidate_date_fallback(spark, sf_dir):
    """Over all deduplicated rows: those without a date get the load date's."""
    return consolidate(stamp_run_date(deduped(spark, sf_dir), RUN_DATE), date_fallback="odate")


def q_lexicon_flags(spark, sf_dir):
    v = valid(spark, sf_dir).withColumn("comment", F.coalesce("snippet", "title"))
    return lexicon_flags(v, "comment", DATA_LEXICON).select("id", "is_positive", "is_negative")


def q_lexicon_flags_default(spark, sf_dir):
    """The default lexicon. Common words of the test prose are read as words of it."""
    said = "coalesce(snippet, title)"
    for word, other in ((" that ", " ÓTIMO "), (" with ", " não "), (" this ", " ruim ")):
        said = f"replace({said}, '{word}', '{other}')"
    v = valid(spark, sf_dir).selectExpr("id", f"{said} AS comment")
    return lexicon_flags(v, "comment", DEFAULT_LEXICON).select("id", "is_positive", "is_negative")


def q_gold_rollup_spread(spark, sf_dir):
    v = stamp_run_date(valid(spark, sf_dir), RUN_DATE)
    c = filter_period(consolidate(v, date_fallback="odate"))
    return gold_rollup(c, DATA_LEXICON, with_spread=True)


# -- views and reports ----------------------------------------------------------
def q_history_view(spark, sf_dir):
    return _history_out(history_view(valid(spark, sf_dir)))


def history_view_rows(spark, sf_dir) -> int:
    return history_view(valid(spark, sf_dir)).count()


def _report_inputs(spark, sf_dir):
    d = deduped(spark, sf_dir)
    summary = quality_summary(d).collect()[0]
    verdict_rows = verdicts(summary_frame(spark, summary)).collect()
    v, _ = validate_ingest(d, RUN_DATE, summary)
    type_client = segment_list(v).collect()[0]["type_client"]
    return summary, verdict_rows, type_client


def flatten_report(report: DataFrame) -> DataFrame:
    return report.select(
        "application_id",
        F.col("owner.team").alias("owner_team"),
        F.col("owner.project").alias("owner_project"),
        F.col("owner.layer").alias("owner_layer"),
        F.col("valid_data.count").alias("valid_count"),
        F.col("valid_data.percentage").alias("valid_pct"),
        F.col("invalid_data.count").alias("invalid_count"),
        F.col("invalid_data.percentage").alias("invalid_pct"),
        "total_records",
        "total_processing_time",
        F.col("validation_results.duplicate_check.code").alias("duplicate_code"),
        F.col("validation_results.null_check.code").alias("null_code"),
        F.col("validation_results.type_consistency_check.code").alias("type_code"),
        "success_count",
        "error_count",
        "type_client",
        F.col("source.app").alias("source_app"),
        F.col("source.search").alias("source_search"),
        F.col("run_ts.start_ts").alias("start_ts"),
        F.col("run_ts.end_ts").alias("end_ts"),
        "timestamp",
    )


def q_run_report(spark, sf_dir):
    summary, verdict_rows, type_client = _report_inputs(spark, sf_dir)
    return flatten_report(run_report(spark, summary, verdict_rows, type_client, RUN))


def q_failure_report(spark, sf_dir):
    rep = failure_report(spark, "feed scan failed", RUN, df=valid(spark, sf_dir), tower="data")
    return rep.withColumn("client", F.array_join("client", ","))


# -- sinks --------------------------------------------------------------------------
def q_sink_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "gold")
    write_partitioned_parquet(gold(spark, sf_dir), path, RUN_DATE, "valid")
    return read_partitioned_parquet(spark, path)


def q_sink_invalid_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "invalid")
    _, inv = validate_ingest(deduped(spark, sf_dir), RUN_DATE, summary=None)
    if not write_partitioned_parquet(inv, path, RUN_DATE, "invalid"):
        return inv.limit(0)
    return read_partitioned_parquet(spark, path).select(*UNIFIED_COLUMNS, "odate")


def q_sink_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "gold_documents")
    write_documents(gold(spark, sf_dir), path)
    return read_documents(spark, path, GOLD_SCHEMA)


def q_sink_report_roundtrip(spark, sf_dir):
    """The run report appended twice to a fresh table and read back."""
    path = scratch_path(spark, "report")
    summary, verdict_rows, type_client = _report_inputs(spark, sf_dir)
    report = run_report(spark, summary, verdict_rows, type_client, RUN)
    append_report(report, path)
    append_report(report, path)
    return flatten_report(spark.read.schema(report.schema).json(path))


def q_sink_report_replay(spark, sf_dir):
    """The run report appended twice by one run (a retried driver) and once by the next."""
    path = scratch_path(spark, "report")
    summary, verdict_rows, type_client = _report_inputs(spark, sf_dir)
    for run in (RUN, RUN, replace(RUN, application_id="run-0002")):
        report = run_report(spark, summary, verdict_rows, type_client, run)
        append_report(report, path, run_key=f"{run.application_id}:{RUN_DATE}")
    return flatten_report(spark.read.schema(report.schema).json(path))


def q_sink_dated_roundtrip(spark, sf_dir):
    """All deduplicated rows as a backfill, each under its own review month, read back."""
    path = scratch_path(spark, "dated")
    month = "coalesce(regexp_replace(regexp_extract(iso_date, '^[0-9]{4}-[0-9]{2}', 0), '-', ''), '') AS month"
    dated = deduped(spark, sf_dir).selectExpr("*", month).selectExpr("*", "if(month = '', '19700101', concat(month, '01')) AS odate")
    write_dated_parquet(dated.drop("month"), path)
    return read_partitioned_parquet(spark, path).select("id", "app", "app_source", "iso_date", "odate")


# -- history, a day at a time -------------------------------------------------------
# Load dates up to this one are the first day's feeds, later ones the second's.
FIRST_DAY = "20240315"
# Buckets of the queries' stores.
QUERY_BUCKETS = 8


def _two_days(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    feeds = derived_feeds(spark, sf_dir)
    return [
        harmonize_all({name: df.where(when(load_date_of(name))) for name, df in feeds.items()})
        for when in (lambda d: d <= FIRST_DAY, lambda d: d > FIRST_DAY)
    ]


def q_incremental_dedup(spark, sf_dir):
    """Survivors of two days, merged one after the other: the dedup of both together."""
    store = SurvivorStore(spark, scratch_path(spark, "survivors"), QUERY_BUCKETS)
    for day in _two_days(spark, sf_dir):
        store.merge(day)
    return store.read()


def q_incremental_changes(spark, sf_dir):
    """What the second day does to the keys of the first."""
    store = SurvivorStore(spark, scratch_path(spark, "survivors"), QUERY_BUCKETS)
    first, second = _two_days(spark, sf_dir)
    store.merge(first)
    return store.changes(second)


def _history_out(df: DataFrame) -> DataFrame:
    return df.select(
        "title", "snippet", "app_source", "app", "segmento", "rating",
        F.unix_micros("iso_date").alias("iso_date_us"),
    )


def q_sink_history_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "history_documents")
    h = history_view(valid(spark, sf_dir))
    write_documents(h, path)
    return _history_out(read_documents(spark, path, h.schema))


def pipeline_run(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    """One full run of the daily job per fresh call; its outputs are read back."""
    base = scratch_path(spark, "pipeline")
    cfg = PipelineConfig(targets=Targets.under(base), run_date=RUN_DATE, run=RUN, lexicon=DATA_LEXICON)
    run_pipeline(spark, derived_feeds(spark, sf_dir), cfg)
    return cfg


def q_pipeline_gold(spark, sf_dir):
    return read_partitioned_parquet(spark, pipeline_run(spark, sf_dir).targets.gold)


def q_pipeline_incremental(spark, sf_dir):
    """Gold of the second of two daily runs, each given only its own day's feeds."""
    base, days = scratch_path(spark, "incremental"), derived_feeds(spark, sf_dir)
    for date, when in (("20240430", lambda d: d <= FIRST_DAY), (RUN_DATE, lambda d: d > FIRST_DAY)):
        feeds = {name: df.where(when(load_date_of(name))) for name, df in days.items()}
        cfg = PipelineConfig(Targets.under(base), date, RUN, DATA_LEXICON, survivors=f"{base}/survivors", survivor_buckets=QUERY_BUCKETS)
        run_pipeline(spark, feeds, cfg)
    return read_partitioned_parquet(spark, cfg.targets.gold).where(F.col("odate") == RUN_DATE)


def q_pipeline_outputs(spark, sf_dir):
    """Row counts of every published output of one run, by output name."""
    t = pipeline_run(spark, sf_dir).targets
    parts = [
        read_partitioned_parquet(spark, t.gold).select(F.lit("gold").alias("output")),
        read_partitioned_parquet(spark, t.invalid).select(F.lit("invalid").alias("output")),
        spark.read.text(documents_path(spark, t.gold_documents)).select(F.lit("gold_documents").alias("output")),
        spark.read.text(documents_path(spark, t.history_documents)).select(F.lit("history_documents").alias("output")),
        spark.read.text(t.report).select(F.lit("report").alias("output")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("output").agg(F.count(F.lit(1)).alias("n_rows"))


def q_pipeline_report(spark, sf_dir):
    """The run report the job appended (its counts come from the observed metrics)."""
    t = pipeline_run(spark, sf_dir).targets
    return flatten_report(spark.read.schema(REPORT_SCHEMA).json(t.report))


def q_pipeline_invalid(spark, sf_dir):
    t = pipeline_run(spark, sf_dir).targets
    return read_partitioned_parquet(spark, t.invalid).select(*UNIFIED_COLUMNS, "odate")


def q_pipeline_history(spark, sf_dir):
    t = pipeline_run(spark, sf_dir).targets
    schema = history_projection(valid(spark, sf_dir)).schema
    return _history_out(read_documents(spark, t.history_documents, schema))


def queries() -> dict[str, Query]:
    return {
        "scan_feeds": q_scan_feeds,
        "scan_with_schema": q_scan_with_schema,
        "scan_provenance": q_scan_provenance,
        "scan_load_date": q_scan_load_date,
        "feed_row_counts": q_feed_row_counts,
        "harmonize_a": _harmonized(STORE_A),
        "harmonize_b": _harmonized(INTERNAL_DB),
        "harmonize_c": _harmonized(STORE_B),
        "union_feeds": unified,
        "dedup_by_key": deduped,
        "rating_casts": q_rating_casts,
        "valid_rows": valid,
        "invalid_rows": q_invalid_rows,
        "stamp_run_date": q_stamp_run_date,
        "consolidate": lambda s, d: consolidate(valid(s, d)),
        "consolidate_date_fallback": q_consolidate_date_fallback,
        "period_filter": lambda s, d: filter_period(consolidate(valid(s, d))),
        "lexicon_flags": q_lexicon_flags,
        "lexicon_flags_default": q_lexicon_flags_default,
        "gold_rollup": gold,
        "gold_rollup_spread": q_gold_rollup_spread,
        "preview_gold": lambda s, d: preview(gold(s, d), 20),
        "duplicate_keys": lambda s, d: duplicate_keys(unified(s, d)),
        "duplicate_rows": lambda s, d: duplicate_rows(unified(s, d)),
        "quality_nulls": lambda s, d: null_counts(unified(s, d)),
        "quality_type": lambda s, d: non_numeric_ratings(unified(s, d)).select("id", "app_source", "rating"),
        "quality_summary": lambda s, d: quality_summary(unified(s, d)),
        "quality_verdicts": lambda s, d: verdicts(quality_summary(unified(s, d))),
        "invalid_rows_with_dups": q_invalid_rows_with_dups,
        "history_view": q_history_view,
        "segment_list": lambda s, d: segment_list(valid(s, d)),
        "row_to_json": lambda s, d: rows_to_json(gold(s, d)),
        "run_report": q_run_report,
        "failure_report": q_failure_report,
        "sink_parquet_roundtrip": q_sink_parquet_roundtrip,
        "sink_invalid_roundtrip": q_sink_invalid_roundtrip,
        "sink_json_roundtrip": q_sink_json_roundtrip,
        "sink_report_roundtrip": q_sink_report_roundtrip,
        "sink_history_roundtrip": q_sink_history_roundtrip,
        "sink_report_replay": q_sink_report_replay,
        "sink_dated_roundtrip": q_sink_dated_roundtrip,
        "incremental_dedup": q_incremental_dedup,
        "incremental_changes": q_incremental_changes,
        "pipeline_incremental": q_pipeline_incremental,
        "pipeline_gold": q_pipeline_gold,
        "pipeline_outputs": q_pipeline_outputs,
        "pipeline_history": q_pipeline_history,
        "pipeline_report": q_pipeline_report,
        "pipeline_invalid": q_pipeline_invalid,
    }
