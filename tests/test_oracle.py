"""Every registered query equals its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as entry_module
from scales import SF_ORACLE
from critiq.plans import oracles, queries
from oracle_compare import compare, duck

QUERIES = queries.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, detail = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_ORACLE)
    assert ok, detail


def test_entry_has_every_query_and_oracle():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == [
        "app_name", "channel", "period", "segment",
        "avg_rating", "n_reviews", "n_positive", "n_negative",
    ]


@pytest.mark.parametrize("name", ["history_view", "rating_casts", "gold_rollup_spread", "scan_load_date", "run_report"])
def test_results_do_not_depend_on_session_zone_or_ansi(spark, con, name):
    keys = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        ok, detail = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_ORACLE)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert ok, detail
