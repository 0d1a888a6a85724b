"""Hot keys: one key holds a third of all rows, NULL another third.

The shuffle-write record counts (from Spark's status store) show that the
dedup and the per-key aggregations reduce each hot group map-side to at most
one row per map task before the shuffle.
"""

from pyspark.sql import functions as F

from critiq.operators import dedup_by_key, duplicate_keys, quality_summary

N = 30_000
MAP_TASKS = 6


def skewed(spark):
    third = N // 3
    df = spark.range(0, N, 1, MAP_TASKS).select(
        F.when(F.col("id") < third, F.lit("hot"))
        .when(F.col("id") < 2 * third, F.lit(None).cast("string"))
        .otherwise(F.col("id").cast("string"))
        .alias("id"),
        F.lit("app").alias("app"),
        F.lit("pf").alias("segmento"),
        (F.col("id") % 5).cast("string").alias("rating"),
        F.lit("2024-01-01T00:00:00Z").alias("iso_date"),
        F.lit("t").alias("title"),
        F.col("id").cast("string").alias("snippet"),
        F.lit("google_play").alias("app_source"),
    )
    return df, N - 2 * third  # distinct non-hot keys


def shuffle_records_written(df) -> int:
    """Run ``df`` and sum the records written by every shuffle of its final plan."""
    df.collect()
    stack = [df._jdf.queryExecution().executedPlan()]
    total, seen = 0, 0
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            stack.append(node.plan())
            continue
        metrics = node.metrics()
        if metrics.contains("shuffleRecordsWritten"):
            total += metrics.apply("shuffleRecordsWritten").value()
            seen += 1
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    assert seen > 0, "no shuffle found"
    return total


def test_dedup_sends_one_row_per_hot_key_per_map_task(spark):
    df, cold = skewed(spark)
    written = shuffle_records_written(dedup_by_key(df))
    assert written <= cold + 2 * MAP_TASKS, written
    got = dedup_by_key(df).agg(F.count(F.lit(1)), F.count_if(F.col("id") == "hot"), F.count_if(F.col("id").isNull()))
    assert tuple(got.collect()[0]) == (cold + 2, 1, 1)


def test_key_counts_combine_before_the_shuffle(spark):
    df, cold = skewed(spark)
    written = shuffle_records_written(duplicate_keys(df))
    assert written <= cold + 2 * MAP_TASKS, written
    keys = {r["id"]: r["n"] for r in duplicate_keys(df).collect()}
    assert keys == {"hot": N // 3, None: N // 3}


def test_summary_on_skewed_input(spark):
    df, _ = skewed(spark)
    s = quality_summary(df).collect()[0]
    assert (s["total_records"], s["dup_keys"], s["dup_rows"], s["null_id"]) == (N, 2, N // 3, N // 3)


def test_gold_rollup_hot_group_combines_before_the_shuffle(spark):
    from critiq.operators import consolidate, gold_rollup

    df, cold = skewed(spark)
    valid = df.where("id IS NOT NULL")  # hot id rows stay: one gold group gets a third of all rows
    gold = gold_rollup(consolidate(valid))
    written = shuffle_records_written(gold)
    # one partial row per group and map task: the hot group costs MAP_TASKS rows, not N / 3
    assert written <= MAP_TASKS * gold.count(), written


def test_history_view_hot_duplicate_row_combines_before_the_shuffle(spark):
    from critiq.operators import history_view

    df, cold = skewed(spark)
    # a third of the rows are the very same review (same text, date, rating, ...)
    copies = df.selectExpr(
        "id", "app", "segmento", "CASE WHEN id = 'hot' THEN '4' ELSE rating END AS rating",
        "iso_date", "title", "CASE WHEN id = 'hot' THEN 'same' ELSE snippet END AS snippet", "app_source",
    ).where("id IS NOT NULL")
    view = history_view(copies)
    written = shuffle_records_written(view)
    assert written <= cold + MAP_TASKS, written
    assert view.count() == cold + 1
