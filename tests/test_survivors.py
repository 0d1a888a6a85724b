"""Dedup over history, a day at a time."""

import random

import pytest

from critiq.operators import SurvivorStore, dedup_by_key
from critiq.schema import UNIFIED_COLUMNS, UNIFIED_SCHEMA
from critiq.session import scratch_path
from critiq.sources import versions

FEEDS = ("google_play", "internal_database_mongodb", "apple_store")


def random_days(n_days, n_rows, seed):
    rng = random.Random(seed)
    days = []
    for _ in range(n_days):
        rows = []
        for _ in range(n_rows):
            key = rng.choice([None, "", "=", *map(str, range(12))])
            few = [rng.choice([None, "a", "b"]) for _ in range(3)]
            date = rng.choice([None, "2024-01-01", "2024-01-02"])
            rows.append((key, few[0], "pf", rng.choice([None, "1", "2"]), date, few[1], few[2], rng.choice(FEEDS)))
        days.append(rows + rows[:2])
    return days


def frame(spark, rows):
    return spark.createDataFrame(rows, UNIFIED_SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*UNIFIED_COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_merging_days_equals_one_dedup(spark, seed):
    days = random_days(3, 25, seed)
    want = rows_of(dedup_by_key(frame(spark, [r for day in days for r in day])))
    for order in (days, days[::-1], [*days, days[0]]):  # any order, and a day twice
        store = SurvivorStore(spark, scratch_path(spark, "t_store"), 4)
        for day in order:
            store.merge(frame(spark, day))
        assert rows_of(store.read()) == want


def test_a_day_reads_and_writes_only_its_buckets_and_shuffles_only_itself(spark):
    path = scratch_path(spark, "t_touched")
    store = SurvivorStore(spark, path, 16)
    history = [(str(i), "app", "pf", "1", "2024-01-01", "t", "s", "google_play") for i in range(400)]
    assert store.merge(frame(spark, history)).touched == list(range(16))
    _, before = store._manifest()
    day = frame(spark, [(k, "app", "pf", "5", "2024-02-01", "t", "new", "google_play") for k in ("7", "8", "new")])
    joined, touched, _ = store.joined(day)
    assert 1 <= len(touched) <= 3
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("== Final Plan ==") : plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert final.count("Exchange hashpartitioning") == 1  # the day's side
    assert "Bucketed: true" in final and "bucket" in final.split("PartitionFilters")[0]
    files = {f.rsplit("/", 2)[1] for f in store._rows({b: before[b] for b in touched}).inputFiles()}
    assert files == {f"bucket={b}" for b in touched}
    assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final
    assert store.merge(day).touched == touched
    _, after = store._manifest()
    assert {b for b in after if after[b] != before[b]} == set(touched)
    got = {r["id"]: r["snippet"] for r in store.read().collect()}
    assert len(got) == 401 and [got[k] for k in ("7", "8", "new", "9")] == ["new", "new", "new", "s"]


def test_a_failed_merge_leaves_the_store(spark):
    path = scratch_path(spark, "t_broken")
    store = SurvivorStore(spark, path, 4)
    rows = random_days(1, 20, 5)[0]
    store.merge(frame(spark, rows))
    want, state = rows_of(store.read()), versions.current(spark, path)
    broken = frame(spark, rows).selectExpr("raise_error('boom') AS id", *UNIFIED_COLUMNS[1:])
    with pytest.raises(Exception, match="boom"):
        store.merge(broken)
    assert versions.current(spark, path) == state and rows_of(store.read()) == want
    assert store.merge(frame(spark, [])).touched == [] and rows_of(store.read()) == want


def test_a_reader_keeps_what_it_has_resolved(spark):
    store = SurvivorStore(spark, scratch_path(spark, "t_reader"), 4)
    first, second = random_days(2, 20, 6)
    store.merge(frame(spark, first))
    early = store.read()
    want = rows_of(early)
    store.merge(frame(spark, second))
    assert rows_of(early) == want


def test_changes_say_what_a_day_does(spark):
    store = SurvivorStore(spark, scratch_path(spark, "t_changes"), 4)
    base = ("app", "pf", "1")
    store.merge(frame(spark, [(k, *base, "2024-01-02", "t", "s", "google_play") for k in ("a", "b", None)]))
    day = [("a", *base, "2024-01-03", "t", "s", "google_play"), ("b", *base, "2024-01-01", "t", "s", "google_play"),
           (None, *base, "2024-01-09", "t", "s", "apple_store"), ("c", *base, None, "t", "s", "apple_store")]
    got = {r["change"]: r["n_keys"] for r in store.changes(frame(spark, day)).collect()}
    assert got == {"inserted": 1, "replaced": 1, "kept": 2}
