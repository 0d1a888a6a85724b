"""The whole job at sf0.001: outputs, rerun stability, failure path."""


import pytest

from scales import SF_SMOKE
from critiq.plans import queries as Q
from critiq.plans.pipeline import PipelineConfig, Targets, run_pipeline
from critiq.session import scratch_path
from critiq.sources import documents_path
from critiq.sources.feeds import EmptyFeedsError
from critiq.sources.testbed import DATA_LEXICON, derived_feeds


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def run(spark):
    cfg = PipelineConfig(
        targets=Targets.under(scratch_path(spark, "t_pipeline")),
        run_date=Q.RUN_DATE,
        run=Q.RUN,
        lexicon=DATA_LEXICON,
        preview_rows=5,
    )
    result = run_pipeline(spark, derived_feeds(spark, SF_SMOKE), cfg)
    return cfg, result


def test_outputs(spark, run):
    cfg, result = run
    t = cfg.targets
    gold = spark.read.parquet(t.gold).drop("odate")
    assert rows(gold) == rows(Q.gold(spark, SF_SMOKE))
    assert spark.read.json(documents_path(spark, t.gold_documents)).count() == gold.count()
    assert spark.read.json(documents_path(spark, t.history_documents)).count() == Q.history_view_rows(spark, SF_SMOKE)
    invalid = spark.read.parquet(t.invalid)
    assert invalid.count() == result.summary["n_invalid"] > 1
    report = spark.read.json(t.report).collect()
    assert len(report) == 1
    r = report[0]
    assert r["valid_data"]["count"] == result.summary["n_valid"]
    assert r["total_records"] == result.summary["n_valid"] + result.summary["n_invalid"]
    assert r["validation_results"]["duplicate_check"]["code"] == 200
    assert r["success_count"] + r["error_count"] == 3
    assert r["type_client"] == result.type_client
    assert {k: len(v) for k, v in result.preview.items()} == {
        "google_play": 5, "internal_database_mongodb": 5, "apple_store": 5, "deduplicated": 5, "gold": 5,
    }
    assert set(result.schemas) == {"google_play", "internal_database_mongodb", "apple_store", "deduplicated", "gold"}
    assert sum(result.kept_by_source.values()) == result.summary["total_records"]
    feeds = derived_feeds(spark, SF_SMOKE)
    assert result.rows_by_source == {name: feeds[name].count() for name in feeds}
    assert result.kept_by_source["internal_database_mongodb"] < result.rows_by_source["internal_database_mongodb"]


def test_rerun_of_the_same_day_is_stable(spark, run):
    cfg, _ = run
    before = rows(spark.read.parquet(cfg.targets.gold))
    run_pipeline(spark, derived_feeds(spark, SF_SMOKE), cfg)
    assert rows(spark.read.parquet(cfg.targets.gold)) == before
    assert spark.read.json(cfg.targets.report).count() == 1  # the same run: its report is replaced


def test_all_empty_feeds_fail_with_a_report(spark):
    feeds = {k: v.limit(0) for k, v in derived_feeds(spark, SF_SMOKE).items()}
    cfg = PipelineConfig(targets=Targets.under(scratch_path(spark, "t_empty_run")), run_date="20240502", run=Q.RUN)
    with pytest.raises(EmptyFeedsError):
        run_pipeline(spark, feeds, cfg)
    failure = spark.read.json(cfg.targets.failures).collect()
    assert len(failure) == 1 and "every feed is empty" in failure[0]["error"]
    assert failure[0]["client"] == ["UNKNOWN_CLIENT"]


def test_stage_table_is_removed_after_the_run(spark, run):
    import glob
    import os

    from critiq.session import local_path, shared_root

    root = local_path(shared_root(spark))
    assert glob.glob(os.path.join(root, "critiq", "stage-*")) == []


def test_shuffle_partitions_follow_the_input_and_are_restored(spark):
    from critiq.session import input_bytes, shuffle_partitions_for

    feeds = derived_feeds(spark, SF_SMOKE)
    unified = Q.unified(spark, SF_SMOKE)
    size = input_bytes(unified)
    assert size > 0
    assert shuffle_partitions_for(unified, 1 << 40, current=8) == 8  # never lowered
    assert shuffle_partitions_for(unified, size // 10 + 1, current=1) == 10



def test_two_runs_at_once_leave_the_session_alone(spark):
    from threading import Thread

    before = spark.conf.get("spark.sql.shuffle.partitions")
    cfgs = [
        PipelineConfig(targets=Targets.under(scratch_path(spark, f"t_two{i}")), run_date=Q.RUN_DATE, run=Q.RUN, lexicon=DATA_LEXICON)
        for i in range(2)
    ]
    threads = [Thread(target=run_pipeline, args=(spark, derived_feeds(spark, SF_SMOKE), c)) for c in cfgs]
    for t in threads:
        t.start()
    while any(t.is_alive() for t in threads):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        threads[0].join(0.2)
        threads[1].join(0.2)
    a, b = (spark.read.text(documents_path(spark, c.targets.history_documents)) for c in cfgs)
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_sequential_publishing_gives_the_same_outputs(spark, run):
    cfg, _ = run
    seq = PipelineConfig(
        targets=Targets.under(scratch_path(spark, "t_seq")),
        run_date=Q.RUN_DATE,
        run=Q.RUN,
        lexicon=DATA_LEXICON,
        parallel_outputs=False,
    )
    run_pipeline(spark, derived_feeds(spark, SF_SMOKE), seq)
    for out in ("gold", "invalid"):
        a = spark.read.parquet(getattr(cfg.targets, out))
        b = spark.read.parquet(getattr(seq.targets, out))
        assert a.count() == b.count() and a.exceptAll(b).count() == 0
    a = spark.read.text(documents_path(spark, cfg.targets.history_documents))
    b = spark.read.text(documents_path(spark, seq.targets.history_documents))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_publishing_threads_keep_the_callers_job_group(spark):
    sc = spark.sparkContext
    cfg = PipelineConfig(
        targets=Targets.under(scratch_path(spark, "t_group")), run_date=Q.RUN_DATE, run=Q.RUN, lexicon=DATA_LEXICON
    )
    sc.setJobGroup("t-group", "pipeline under a job group", False)
    try:
        run_pipeline(spark, derived_feeds(spark, SF_SMOKE), cfg)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    # staging, gold, gold documents, invalid, history and report jobs all carry the group
    assert len(sc.statusTracker().getJobIdsForGroup("t-group")) >= 8


def test_report_carries_step_seconds(spark, run):
    cfg, result = run
    steps = spark.read.json(cfg.targets.report).collect()[0]["steps"].asDict()
    assert {"dedup_stage", "gold", "invalid", "history_documents", "publish"} <= set(steps)
    assert all(v >= 0 for v in steps.values())


def test_load_and_validate_from_feed_directories(spark):
    from critiq import load_reviews, validate
    from critiq.sources.testbed import write_landing_zone

    paths = write_landing_zone(spark, SF_SMOKE, scratch_path(spark, "t_load"))
    reviews = load_reviews(spark, paths)
    assert sorted(map(tuple, reviews.collect()), key=str) == sorted(
        map(tuple, Q.deduped(spark, SF_SMOKE).collect()), key=str
    )
    checked = validate(reviews, Q.RUN_DATE)
    assert checked.valid.count() == Q.valid(spark, SF_SMOKE).count()
    codes = {r["check"]: r["code"] for r in checked.verdicts.collect()}
    assert codes["duplicate_check"] == 200 and codes["null_check"] == 400
    # a load-date window prunes the feeds before they are read
    feb = load_reviews(spark, paths, odate_from="20240201", odate_to="20240229")
    assert 0 < feb.count() < reviews.count()


def test_gold_can_be_published_under_the_original_names(spark, run):
    from critiq.schema import ORIGINAL_GOLD_NAMES

    cfg, _ = run
    named = PipelineConfig(
        targets=Targets.under(scratch_path(spark, "t_names")),
        run_date=Q.RUN_DATE,
        run=Q.RUN,
        lexicon=DATA_LEXICON,
        original_gold_names=True,
        preview_rows=3,
    )
    result = run_pipeline(spark, derived_feeds(spark, SF_SMOKE), named)
    gold = spark.read.parquet(named.targets.gold).drop("odate")
    expected = [ORIGINAL_GOLD_NAMES[c] for c in Q.gold(spark, SF_SMOKE).columns]
    assert gold.columns == expected
    ours = spark.read.parquet(cfg.targets.gold).drop("odate")
    assert gold.toDF(*ours.columns).exceptAll(ours).count() == 0 and gold.count() == ours.count()
    docs = spark.read.json(documents_path(spark, named.targets.gold_documents))
    assert set(docs.columns) <= set(expected) and "nota_media" in docs.columns
    assert len(result.preview["gold"]) == 3
