"""Data-quality checks and the valid / invalid split.

Three checks run over the unified rows: repeated keys (409), nulls in
critical columns (400) and non-numeric ratings (400). All their counts, plus
the valid / invalid row counts, come from one aggregation job
(``quality_summary``); the verdicts are a DataFrame derived from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from critiq.functions.casts import legacy_int_sql
from critiq.functions.sql import ident
from critiq.operators.repeats import marks, with_mark
from critiq.schema import CRITICAL_COLUMNS, INVALID_PREDICATE_COLUMNS, UNIFIED_COLUMNS
from critiq.sources.sinks import stamp_run_date

CHECKS = ("duplicate_check", "null_check", "type_consistency_check")

# Every critical column is set.
VALID_SQL = " AND ".join(f"{c} IS NOT NULL" for c in CRITICAL_COLUMNS)
# A key column other than ``snippet`` is NULL.
INVALID_SQL = " OR ".join(f"{c} IS NULL" for c in INVALID_PREDICATE_COLUMNS)
# Strict: any critical column is NULL, so every row is valid or invalid.
STRICT_INVALID_SQL = f"NOT ({VALID_SQL})"


def invalid_sql(strict: bool = False) -> str:
    return STRICT_INVALID_SQL if strict else INVALID_SQL
# The rating does not read as an integer (NULL included).
BAD_RATING_SQL = f"{legacy_int_sql('rating')} IS NULL"


def valid_predicate() -> Column:
    return F.expr(VALID_SQL)


def invalid_predicate() -> Column:
    return F.expr(INVALID_SQL)


def valid_rows(df: DataFrame) -> DataFrame:
    return df.select(*UNIFIED_COLUMNS).where(VALID_SQL)


def invalid_rows(df: DataFrame, strict: bool = False) -> DataFrame:
    """Rows with a NULL key column other than ``snippet`` (parity with the
    original job: a row whose only NULL is the snippet is in neither set);
    ``strict`` also counts a NULL snippet, so every row is in one set."""
    return df.select(*UNIFIED_COLUMNS).where(invalid_sql(strict))


def duplicate_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """Keys that occur more than once, with their count ``n``; NULL is a key.

    Partial aggregation runs before the shuffle, so a hot key costs one row
    per map task.
    """
    return df.groupBy(key).agg(F.expr("count(1) AS n")).where("n > 1")


def duplicate_rows(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key repeats (NULL keys never match).

    An inner join against the repeated keys, each of which is there once. A bit map of those keys, broadcast
    to the scan (``critiq.operators.repeats``), lets only rows through whose key may repeat, so the rows that are shuffled
    are in proportion to the repeated keys. AQE turns the join into a broadcast join when the key set proves small at
    run time and splits a skewed key's partition otherwise.
    """
    keys = _repeated_keys(df, key)
    rows = may_repeat(df, keys, key, unmarked=False).where("_marked").drop("_marked")
    return rows.join(keys, F.col(key) == F.col("_repeated")).drop("_repeated")


def _repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return duplicate_keys(df, key).where(F.col(key).isNotNull()).select(F.col(key).alias("_repeated"))


def may_repeat(df: DataFrame, keys: DataFrame, key: str = "id", unmarked: bool = True) -> DataFrame:
    """``df`` with ``_marked``: false for rows whose key is certainly not among ``keys`` (``_repeated``)."""
    mapped = marks(keys.selectExpr("xxhash64(_repeated) AS h"), "h")
    return with_mark(df, f"CASE WHEN {ident(key)} IS NOT NULL THEN xxhash64({ident(key)}) END", mapped, unmarked=unmarked)


def invalid_and_duplicate_rows(df: DataFrame, key: str = "id", strict: bool = False) -> DataFrame:
    """``invalid_rows`` and ``duplicate_rows`` in one pass: each row once for each reason.

    The repeated keys are flagged by one left outer join; a row for which both reasons hold
    comes twice. Valid rows whose key certainly does not repeat (``may_repeat``) leave before it.
    """
    rows = df.select(*UNIFIED_COLUMNS)
    keys = _repeated_keys(rows, key)
    rows = may_repeat(rows, keys, key).where(f"_marked OR {invalid_sql(strict)}").drop("_marked")
    reasons = f"array_compact(array(CASE WHEN {invalid_sql(strict)} THEN 1 END, CASE WHEN _repeated IS NOT NULL THEN 2 END))"
    flagged = rows.join(keys, F.col(key) == F.col("_repeated"), "left")
    return flagged.withColumn("_reason", F.explode(F.expr(reasons))).select(*UNIFIED_COLUMNS)


def null_counts(df: DataFrame, columns=CRITICAL_COLUMNS) -> DataFrame:
    """One row: the number of NULLs in each column."""
    return df.agg(*[F.expr(f"count_if({ident(c)} IS NULL) AS {ident(c)}") for c in columns])


def non_numeric_ratings(df: DataFrame) -> DataFrame:
    """Rows whose rating does not read as an integer (NULL ratings included)."""
    return df.where(BAD_RATING_SQL)


SUMMARY_FIELDS = (
    "total_records",
    "dup_keys",
    "dup_rows",
    *[f"null_{c}" for c in CRITICAL_COLUMNS],
    "bad_rating",
    "n_valid",
    "n_invalid_base",
    "n_invalid",
)

def _row_counts_sql(strict: bool = False) -> tuple[str, ...]:
    return (
        *[f"count_if({c} IS NULL) AS null_{c}" for c in CRITICAL_COLUMNS],
        f"count_if({BAD_RATING_SQL}) AS bad_rating",
        f"count_if({VALID_SQL}) AS n_valid",
        f"count_if({invalid_sql(strict)}) AS n_invalid_base",
    )


def summary_aggregates(strict: bool = False) -> list[Column]:
    """The summary measures that need no grouping by key, as global aggregates.

    Usable in ``agg`` or in ``DataFrame.observe`` (metrics gathered while
    another action runs, with no extra scan).
    """
    return [F.expr("count(1) AS total_records"), *[F.expr(e) for e in _row_counts_sql(strict)]]


def summary_frame(spark, summary: Row) -> DataFrame:
    """A collected summary row as a one-row DataFrame, built from JVM literals."""
    return spark.range(0, 1, 1, 1).selectExpr(
        *[f"CAST({int(summary[c])} AS BIGINT) AS {c}" for c in SUMMARY_FIELDS]
    )


def summary_of_unique_keys(metrics: dict) -> Row:
    """The full summary row for rows whose key is unique (``dedup_by_key``
    output: one row per key, NULL included), so no key repeats by
    construction. ``metrics`` holds the values of ``summary_aggregates``."""
    values = {k: int(v) for k, v in metrics.items() if k in SUMMARY_FIELDS}
    values.update(dup_keys=0, dup_rows=0, n_invalid=values["n_invalid_base"])
    return Row(**{k: values[k] for k in SUMMARY_FIELDS})


def quality_summary(df: DataFrame, key: str = "id", strict: bool = False) -> DataFrame:
    """One-row summary of every check, in one job.

    Rows are first aggregated per key (partial aggregation before the shuffle
    on ``key``), then summed globally.
    """
    per_key = df.groupBy(key).agg(F.expr("count(1) AS n"), *[F.expr(e) for e in _row_counts_sql(strict)])
    k = ident(key)

    def total(expr: str, name: str) -> Column:
        return F.expr(f"CAST(coalesce(sum({expr}), 0) AS BIGINT) AS {name}")

    return per_key.agg(
        total("n", "total_records"),
        F.expr("count_if(n > 1) AS dup_keys"),
        total(f"CASE WHEN n > 1 AND {k} IS NOT NULL THEN n END", "dup_rows"),
        *[total(f"null_{c}", f"null_{c}") for c in CRITICAL_COLUMNS],
        total("bad_rating", "bad_rating"),
        total("n_valid", "n_valid"),
        total("n_invalid_base", "n_invalid_base"),
        # Invalid rows = rows with a NULL key column + rows of repeated keys.
        total(f"n_invalid_base + CASE WHEN n > 1 AND {k} IS NOT NULL THEN n ELSE 0 END", "n_invalid"),
    )


def verdicts(summary: DataFrame) -> DataFrame:
    """The three check verdicts: ``check, status, code, n_bad, message, total_records``."""
    null_total = " + ".join(f"null_{c}" for c in CRITICAL_COLUMNS)
    null_detail = ", ".join(
        f"CASE WHEN null_{c} > 0 THEN concat('{c}=', CAST(null_{c} AS STRING)) END" for c in CRITICAL_COLUMNS
    )

    def verdict(name: str, ok: str, fail_code: int, n_bad: str, ok_msg: str, bad_msg: str) -> str:
        return (
            f"named_struct('check', '{name}', 'status', {ok}, "
            f"'code', CASE WHEN {ok} THEN 200 ELSE {fail_code} END, "
            f"'n_bad', CAST({n_bad} AS BIGINT), "
            f"'message', CASE WHEN {ok} THEN '{ok_msg}' ELSE {bad_msg} END)"
        )

    items = ", ".join(
        [
            verdict(
                "duplicate_check", "dup_keys = 0", 409, "dup_keys", "no duplicate records found",
                "concat('duplicate records found: ', CAST(dup_keys AS STRING), ' ids repeat')",
            ),
            verdict(
                "null_check", f"({null_total}) = 0", 400, null_total, "no null values in critical columns",
                f"concat('null values in critical columns: ', concat_ws(', ', {null_detail}))",
            ),
            verdict(
                "type_consistency_check", "bad_rating = 0", 400, "bad_rating", "rating values are numeric",
                "concat('non-numeric values in column rating: ', CAST(bad_rating AS STRING), ' rows')",
            ),
        ]
    )
    return summary.selectExpr(f"inline(array({items}))", "total_records")


def validate_ingest(
    df: DataFrame,
    run_date: str,
    summary: Row | None = None,
    key: str = "id",
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Split into valid and invalid rows, both stamped with the run date.

    Invalid rows are those with a NULL in a key column other than ``snippet``
    (any critical column with ``strict``), plus every row of a repeated key
    (which also stays in the valid set).
    Given an already collected ``summary`` row with no repeated keys, the
    repeated-key join is left out of the plan.
    """
    valid = valid_rows(df)
    if summary is None or summary["dup_keys"] > 0:
        invalid = invalid_and_duplicate_rows(df, key, strict)
    else:
        invalid = invalid_rows(df, strict)
    return stamp_run_date(valid, run_date), stamp_run_date(invalid, run_date)
