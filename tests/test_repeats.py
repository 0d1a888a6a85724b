"""Rows that repeat nothing are not shuffled."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from critiq.operators import distinct_rows, duplicate_rows, exact_mean_sql, gold_rollup
from critiq.operators.quality import invalid_and_duplicate_rows, validate_ingest
from critiq.schema import UNIFIED_COLUMNS
from test_skew import shuffle_records_written

N, REPEATED = 20_000, 50


def wide(spark):
    """N rows with keys of their own, and REPEATED keys that occur three times; NULL keys repeat, too."""
    rows = spark.range(0, N, 1, 6).selectExpr("cast(id as string) AS id")
    again = spark.range(0, 2 * REPEATED, 1, 2).selectExpr(f"cast(id % {REPEATED} as string) AS id")
    none = spark.range(0, 30, 1, 2).selectExpr("cast(null as string) AS id")
    text = "repeat(coalesce(id, 'x'), 50)"
    return rows.union(again).union(none).selectExpr(
        "id", "'app' AS app", "'pf' AS segmento", "'1' AS rating", "'2024-01-01' AS iso_date", "'t' AS title",
        f"{text} AS snippet", "'google_play' AS app_source",
    )


def plain(spark, df):
    rows = [tuple(r) for r in df.select(*UNIFIED_COLUMNS).collect()]
    n = Counter(r[0] for r in rows)
    return rows, n


def test_duplicate_rows_shuffle_in_proportion_to_repeated_keys(spark):
    df = wide(spark)
    rows, n = plain(spark, df)
    got = duplicate_rows(df).select(*UNIFIED_COLUMNS)
    assert Counter(tuple(r) for r in got.collect()) == Counter(r for r in rows if r[0] is not None and n[r[0]] > 1)
    # the key pass sends each distinct key once for each of its tasks; the rest is the repeated rows
    keys = N + 2 * REPEATED + 2
    assert shuffle_records_written(got) <= keys + 10 * REPEATED


def test_invalid_rows_with_repeats_in_one_pass(spark):
    df = wide(spark)
    rows, n = plain(spark, df)
    want = Counter(r for r in rows if r[0] is None) + Counter(r for r in rows if r[0] is not None and n[r[0]] > 1)
    assert Counter(tuple(r) for r in invalid_and_duplicate_rows(df).collect()) == want
    _, invalid = validate_ingest(df, "20240101")
    assert invalid.count() == sum(want.values())


@pytest.mark.parametrize("bits", [6, 10, 24])
def test_distinct_rows_equal_distinct(spark, bits):
    """Also with a map so small that all rows look repeated."""
    df = spark.range(0, 3000, 1, 5).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 400 END AS a", "CASE WHEN id % 2 = 0 THEN 'x' END AS b",
        "cast(id % 7 AS double) AS c", "timestamp_micros(id % 5) AS d",
    )
    got = Counter(tuple(r) for r in distinct_rows(df, bits).collect())
    assert got == Counter({tuple(r): 1 for r in df.distinct().collect()})


def test_distinct_rows_shuffle_no_texts_of_single_rows(spark):
    df = wide(spark).drop("id")
    got = distinct_rows(df)
    hashes = N + 2 * REPEATED + 2
    assert got.count() == N + 1
    assert shuffle_records_written(got) <= hashes + 10 * REPEATED


def test_empty_input(spark):
    df = wide(spark).limit(0)
    assert duplicate_rows(df).count() == 0 and distinct_rows(df).count() == 0


def test_mean_does_not_depend_on_the_partitioning(spark):
    """Ratings whose plain sums of doubles differ with the order, near a half of the last decimal."""
    values = [0.1, 0.2, 0.3, 4.35, 4.45, 1e9, -1e9, 2.25] * 40
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, rating double")
    got = set()
    for k in range(6):
        dealt = rows.repartition(1 + 3 * k, F.xxhash64("i", F.lit(k)))
        got.add(dealt.agg(F.expr(f"round({exact_mean_sql('rating')}, 1) AS m"), F.expr(f"{exact_mean_sql('rating')} AS e")).first())
    assert len(got) == 1
    exact = sum(round(v * 10**6) for v in values) / 10**6 / len(values)
    assert got.pop()["e"] == exact


@pytest.mark.parametrize(
    "values, want",
    [([1.0, 2.0, None], 1.5), ([None, None], None), ([], None), ([1 / 3, 1 / 3], 1 / 3), ([float("inf"), 1.0], float("inf")), ([9e18, 1.0], 4.5e18)],
)
def test_mean_of_other_values(spark, values, want):
    rows = spark.createDataFrame([(v,) for v in values], "rating double")
    assert rows.agg(F.expr(f"{exact_mean_sql('rating')} AS m")).first()["m"] == want


def test_the_text_is_cut_once_for_both_lists(spark):
    rows = spark.createDataFrame(
        [("A", "C", "S", 4.0, "bom, mas ruim", "2024-01"), ("A", "C", "S", 5.0, "bom, não", "2024-01"), ("A", "C", "S", None, None, "2024-01")],
        "app_name string, channel string, segment string, rating double, comment string, period string",
    )
    gold = gold_rollup(rows)
    plan = gold._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
    assert gold.select("avg_rating", "n_reviews", "n_positive", "n_negative").first() == (4.5, 3, 1, 1)
