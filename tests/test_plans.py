"""Physical-plan checks: the plans are the ones intended for scale."""

import pytest

from scales import SF_SMOKE
from critiq.plans import queries as Q

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
PAIR_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")
# Queries that write or run a job before returning; their plans are reads of the output.
EAGER = {"pipeline_gold", "sink_parquet_roundtrip", "sink_invalid_roundtrip", "sink_json_roundtrip",
         "scan_with_schema", "run_report", "failure_report"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - EAGER))
def test_no_python_and_no_pair_joins(spark, name):
    plan = plan_of(Q.queries()[name](spark, SF_SMOKE))
    for node in PYTHON_NODES + PAIR_JOINS:
        assert node not in plan, f"{name}: {node} in plan"


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = plan_of(Q.deduped(spark, SF_SMOKE))
    partial = plan.find("Partial")
    exchange = plan.find("Exchange hashpartitioning(id")
    assert "WindowGroupLimit" in plan and partial != -1 and exchange != -1
    # explain prints the root first: the partial limit sits below (after) the exchange line
    assert exchange < partial


def test_scans_are_pruned_and_filtered(spark):
    plan = Q.unified(spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    # documents: n_chars is never read; conversations: every turn, without its role
    assert "n_chars" not in plan
    assert "role" not in plan


def final_plan(df) -> str:
    """The plan as it ran, without the parts that were reused."""
    df.collect()
    plan = plan_of(df)
    return plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan


def test_repeated_keys_are_flagged_above_the_union(spark):
    """The wide feeds are read once and the keys once: each table twice at most. The map of the
    keys and the join share the pass over them."""
    for name in ("duplicate_rows", "invalid_rows_with_dups"):
        plan = final_plan(Q.queries()[name](spark, SF_SMOKE))
        assert "ReusedExchange" in plan, name
        for table in ("events", "conversations", "documents"):
            assert plan.count(f"{table}.parquet") <= 2, (name, table)


def test_gold_rollup_aggregates_partially_before_shuffle(spark):
    plan = plan_of(Q.gold(spark, SF_SMOKE))
    assert "partial_count" in plan and "partial_try_sum" in plan
    assert "Exchange hashpartitioning(app_name" in plan


def test_preview_is_a_top_k(spark):
    from critiq.operators import preview

    plan = plan_of(preview(Q.gold(spark, SF_SMOKE), 20))
    assert "TakeOrderedAndProject" in plan


def test_labels_join_is_an_equi_join(spark):
    plan = plan_of(Q.unified(spark, SF_SMOKE))
    assert "HashJoin" in plan or "SortMergeJoin" in plan
