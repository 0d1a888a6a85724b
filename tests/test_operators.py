"""Operators on small literal frames."""

import pytest

from critiq.operators import (
    consolidate,
    dedup_by_key,
    duplicate_keys,
    duplicate_rows,
    gold_rollup,
    harmonize,
    history_view,
    quality_summary,
    union_feeds,
    validate_ingest,
    verdicts,
)
from critiq.operators.quality import summary_aggregates, summary_of_unique_keys
from critiq.plans.report import rows_to_json, segment_list
from critiq.schema import UNIFIED_COLUMNS
from critiq.sources import STORE_A, FeedSpec, feed_row_counts, require_rows
from critiq.sources.feeds import EmptyFeedsError
from critiq.functions import Lexicon

COLS = ", ".join(f"{c} string" for c in UNIFIED_COLUMNS)


def rows(spark, data):
    return spark.createDataFrame(data, COLS)


def test_dedup_keeps_one_row_per_key_null_included(spark):
    df = rows(
        spark,
        [
            (None, "x", "s", "1", "2024-01-01", "t", "a", "apple_store"),
            (None, "y", "s", "2", "2024-01-02", "t", "b", "google_play"),
            ("a", "x", "s", "3", "2024-01-01", "t", "c", "apple_store"),
            ("a", "x", "s", "4", "2024-01-05", "t", "d", "apple_store"),
            ("b", "x", "s", "5", "2024-01-01", "t", "e", "apple_store"),
        ],
    )
    got = {r["id"]: (r["app"], r["rating"]) for r in dedup_by_key(df).collect()}
    # feed priority first (google_play beats apple_store), then newest date
    assert got == {None: ("y", "2"), "a": ("x", "4"), "b": ("x", "5")}


def test_dedup_is_deterministic_on_full_ties(spark):
    data = [("k", "x", "s", r, "2024-01-01", "t", "z", "apple_store") for r in ["9", "1", "5"]]
    assert dedup_by_key(rows(spark, data)).collect()[0]["rating"] == "1"


def test_validity_split_and_duplicates(spark):
    df = rows(
        spark,
        [
            ("a", "x", "s", "1", "d", "t", "snip", "src"),
            ("a", "x", "s", "2", "d", "t", "snip", "src"),
            ("b", "x", "s", "3", "d", "t", None, "src"),  # only snippet missing: in neither set
            (None, "x", "s", "3", "d", "t", "snip", "src"),
            ("c", None, "s", "oops", "d", "t", "snip", "src"),
        ],
    )
    valid, invalid = validate_ingest(df, "20240501")
    assert sorted(r["rating"] for r in valid.collect()) == ["1", "2"]
    inv = sorted((r["id"] or "-", r["rating"]) for r in invalid.collect())
    # NULL-key rows plus every row of a repeated key (which stay valid too)
    assert inv == [("-", "3"), ("a", "1"), ("a", "2"), ("c", "oops")]
    assert {r["odate"] for r in invalid.collect()} == {"20240501"}

    s = quality_summary(df).collect()[0]
    assert (s["total_records"], s["dup_keys"], s["dup_rows"], s["null_id"], s["null_app"], s["null_snippet"]) == (
        5, 1, 2, 1, 1, 1,
    )
    assert (s["bad_rating"], s["n_valid"], s["n_invalid"]) == (1, 2, 4)
    v = {r["check"]: r for r in verdicts(quality_summary(df)).collect()}
    assert v["duplicate_check"]["code"] == 409 and not v["duplicate_check"]["status"]
    assert v["null_check"]["message"] == "null values in critical columns: id=1, app=1, snippet=1"
    assert v["type_consistency_check"]["n_bad"] == 1


def test_null_keys_repeat_but_never_join(spark):
    df = rows(spark, [(None, "x", "s", "1", "d", "t", "s", "src")] * 2)
    assert duplicate_keys(df).collect()[0]["n"] == 2
    assert duplicate_rows(df).count() == 0


def test_clean_input_passes_every_check(spark):
    df = rows(spark, [("a", "x", "s", "1", "d", "t", "s", "src"), ("b", "x", "s", "2.0", "d", "t", "s", "src")])
    v = verdicts(quality_summary(df)).collect()
    assert [(r["status"], r["code"]) for r in v] == [(True, 200)] * 3


def test_observed_summary_equals_grouped_summary(spark):
    df = dedup_by_key(
        rows(
            spark,
            [
                (None, "x", "s", "n/a", "d", "t", None, "src"),
                ("a", "x", "s", "1", "d", "t", "s", "src"),
                ("a", "x", "s", "2", "d", "t", "s", "src"),
            ],
        )
    )
    observed = df.agg(*summary_aggregates()).collect()[0].asDict()
    assert summary_of_unique_keys(observed) == quality_summary(df).collect()[0]


def test_harmonize_maps_and_tags(spark):
    raw = spark.createDataFrame(
        [("1", "bank_pf", "pf", 4.7, "2024-01-01T00:00:00Z", "t", "s")],
        "id string, app string, segmento string, rating double, iso_date string, title string, snippet string",
    )
    row = harmonize(raw, STORE_A).collect()[0]
    assert row.asDict() == {
        "id": "1", "app": "bank", "segmento": "pf", "rating": "4", "iso_date": "2024-01-01T00:00:00Z",
        "title": "t", "snippet": "s", "app_source": "google_play",
    }
    with pytest.raises(ValueError):
        harmonize(raw, FeedSpec(name="broken", mapping={"id": "id"}))


def test_union_by_name(spark):
    a = rows(spark, [("1", "x", "s", "1", "d", "t", "s", "a")])
    b = a.select(*reversed(a.columns))
    assert union_feeds([a, b]).collect()[1]["id"] == "1"


def test_gold_rollup_measures(spark):
    df = rows(
        spark,
        [
            ("1", "app", "pf", "5", "2024-02-01T00:00:00Z", "t", "muito bom", "google_play"),
            ("2", "app", "pf", "4", "2024-02-03T00:00:00Z", "t", "ruim", "google_play"),
            ("3", "app", "pf", "n/a", "2024-02-04T00:00:00Z", "t", "bom mas não", "google_play"),
            ("4", "app", "pj", "0", "2024-03-04T00:00:00Z", "t", "ok", "google_play"),
        ],
    )
    g = {(r["period"], r["segment"]): r for r in gold_rollup(consolidate(df), with_spread=True).collect()}
    feb = g[("2024-02", "PF")]
    assert (feb["app_name"], feb["channel"], feb["avg_rating"], feb["n_reviews"]) == ("APP", "GOOGLE_PLAY", 4.5, 3)
    assert (feb["n_positive"], feb["n_negative"], feb["rating_spread_pct"]) == (1, 1, 20.0)
    assert g[("2024-03", "PJ")]["rating_spread_pct"] is None  # max rating 0


def test_round_half_up_on_decimal_text(spark):
    df = rows(spark, [(str(i), "a", "s", r, "2024-01-01", "t", "x", "g") for i, r in enumerate(["3", "3", "4", "3"] * 5)])
    # mean 3.25 -> 3.3 (half up); the decimal text decides, not the binary value
    assert gold_rollup(consolidate(df)).collect()[0]["avg_rating"] == 3.3


def test_history_view_is_distinct_and_typed(spark):
    df = rows(
        spark,
        [
            ("1", "straße", "pf", "3.0", "2024-01-03T10:20:30.123456", "a", "b", "x"),
            ("2", "straße", "pf", "3.0", "2024-01-03T10:20:30.123456", "a", "b", "x"),
        ],
    )
    h = history_view(df).collect()
    assert len(h) == 1
    assert (h[0]["app"], h[0]["rating"], h[0]["title"]) == ("STRASSE", 3, "A")


def test_segment_list(spark):
    df = rows(spark, [("1", "a", "pj", "1", "d", "t", "s", "x"), ("2", "a", None, "1", "d", "t", "s", "x"),
                      ("3", "a", "pf", "1", "d", "t", "s", "x"), ("4", "a", "pf", "1", "d", "t", "s", "x")])
    # sorted on the raw values, upper-cased after joining
    assert segment_list(df).collect()[0][0] == "UNKNOWN,PF,PJ"
    assert segment_list(df.limit(0)).collect()[0][0] == "NA"


def test_row_to_json_leaves_out_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert rows_to_json(df).collect()[0]["json"] == '{"x":"a"}'


def test_feed_row_counts_and_empty_guard(spark):
    a = rows(spark, [("1", "x", "s", "1", "d", "t", "s", "a")])
    empty = a.limit(0)
    counts = feed_row_counts({"one": a, "two": empty})
    assert {r["feed"]: r["n_rows"] for r in counts.collect()} == {"one": 1, "two": 0}
    assert require_rows(counts) == {"one": 1, "two": 0}
    with pytest.raises(EmptyFeedsError):
        require_rows(feed_row_counts({"one": empty, "two": empty}))


def test_custom_lexicon(spark):
    df = rows(spark, [("1", "a", "s", "1", "2024-01-01", "t", "great app\nbad? not bad", "g")])
    lex = Lexicon(positive=("great",), negative=("bad",), negators=("not",))
    r = gold_rollup(consolidate(df), lex).collect()[0]
    assert (r["n_positive"], r["n_negative"]) == (1, 1)


def test_strict_split_puts_every_row_in_one_set(spark):
    df = rows(spark, [("b", "x", "s", "3", "d", "t", None, "src"), ("c", "x", "s", "3", "d", "t", "s", "src")])
    _, lax = validate_ingest(df, "20240501")
    valid, strict = validate_ingest(df, "20240501", strict=True)
    assert lax.count() == 0
    assert [r["id"] for r in strict.collect()] == ["b"]
    assert [r["id"] for r in valid.collect()] == ["c"]
    assert quality_summary(df, strict=True).collect()[0]["n_invalid"] == 1


def test_invalid_and_duplicate_rows_come_once_for_each_reason(spark):
    from collections import Counter

    from critiq.operators.quality import duplicate_rows, invalid_and_duplicate_rows, invalid_rows
    from critiq.schema import UNIFIED_COLUMNS

    rows = [("a", "x"), ("a", None), ("b", "x"), ("c", None), (None, "x"), (None, "x"), ("a", "x")]
    df = spark.createDataFrame([(i, p, "s", "4", "d", "t", "n", "g") for i, p in rows], ", ".join(f"{c} string" for c in UNIFIED_COLUMNS))
    apart = Counter(map(tuple, invalid_rows(df).collect())) + Counter(map(tuple, duplicate_rows(df).collect()))
    assert Counter(map(tuple, invalid_and_duplicate_rows(df).collect())) == apart
    assert sum(apart.values()) == 4 + 3
