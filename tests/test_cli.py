"""The command line runs the job over feeds laid out on disk."""

import pytest

from scales import SF_SMOKE
from critiq import cli
from critiq.plans import queries as Q
from critiq.session import scratch_path
from critiq.sources.testbed import write_landing_zone


def test_cli_runs_the_job_on_feed_directories(spark, capsys):
    paths = write_landing_zone(spark, SF_SMOKE, scratch_path(spark, "t_cli_landing"))
    target = scratch_path(spark, "t_cli_out")
    argv = [f"--feed={name}={path}" for name, path in paths.items()]
    argv += ["--target", target, "--run-date", "20240601", "--env", "pre"]
    result = cli.main(argv, spark=spark)
    out = capsys.readouterr().out
    assert "-- gold:" in out and '"type_client"' in out
    assert result.summary["total_records"] > 0
    gold = spark.read.parquet(f"{target}/gold").drop("odate")
    # Same rollup as the registered query, apart from the lexicon (defaults here).
    assert gold.count() == Q.gold(spark, SF_SMOKE).count()


def test_cli_prunes_load_dates(spark):
    paths = write_landing_zone(spark, SF_SMOKE, scratch_path(spark, "t_cli_landing2"))
    target = scratch_path(spark, "t_cli_out2")
    argv = [f"--feed={name}={path}" for name, path in paths.items()]
    argv += ["--target", target, "--run-date", "20240601", "--odate-from", "20240201", "--odate-to", "20240229"]
    result = cli.main(argv, spark=spark)
    periods = {r["period"] for r in spark.read.parquet(f"{target}/gold").select("period").distinct().collect()}
    assert periods == {"2024-02"}
    assert result.summary["total_records"] > 0


def test_cli_rejects_unknown_feeds():
    with pytest.raises(SystemExit):
        cli.parse_args(["--feed", "nope=/x", "--target", "/t"])
    with pytest.raises(SystemExit):
        cli.parse_args(["--feed", "google_play", "--target", "/t"])


def test_cli_reports_a_feed_it_cannot_open(spark):
    target = scratch_path(spark, "t_cli_missing")
    argv = ["--feed", f"google_play={scratch_path(spark, 'does-not-exist')}", "--target", target, "--run-date", "20240601"]
    with pytest.raises(Exception):
        cli.main(argv, spark=spark)
    failure = spark.read.json(f"{target}/report/failure").collect()
    assert len(failure) == 1 and failure[0]["client"] == ["UNKNOWN_CLIENT"]
