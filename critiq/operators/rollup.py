"""Consolidated review rows and the gold monthly rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from critiq.functions.casts import lenient_double_sql
from critiq.functions.dates import period_of_sql
from critiq.functions.sql import ident, string_literal
from critiq.functions.text import DEFAULT_LEXICON, Lexicon, classified
from critiq.schema import GOLD_KEYS, ORIGINAL_GOLD_NAMES

# Fixed value: a well-formed reporting period is ``yyyy-MM``.
PERIOD_PATTERN = r"^\d{4}-\d{2}$"


def consolidate(valid: DataFrame, date_fallback: str | None = None) -> DataFrame:
    """One consolidated row per valid review.

    Rating becomes a double (NULL when not a number); the comment is the
    snippet, else the title; the client name is the title when a snippet
    exists; app, channel and segment are upper-cased and the period is the
    date's ``yyyy-MM`` prefix. ``date_fallback`` (a column name or SQL
    expression, e.g. the load date) fills missing review dates.
    """
    date = "iso_date" if date_fallback is None else f"coalesce(iso_date, {date_fallback})"
    return valid.selectExpr(
        "upper(app) AS app_name",
        "upper(app_source) AS channel",
        "upper(segmento) AS segment",
        f"{lenient_double_sql('rating')} AS rating",
        f"{date} AS review_date",
        "coalesce(snippet, title) AS comment",
        "CAST(NULL AS STRING) AS app_version",
        "CASE WHEN snippet IS NOT NULL THEN title END AS client_name",
        f"{period_of_sql(date)} AS period",
    )


def filter_period(df: DataFrame, pattern: str = PERIOD_PATTERN, column: str = "period") -> DataFrame:
    """Keep rows whose period is well formed."""
    return df.where(f"{ident(column)} RLIKE {string_literal(pattern)}")


def lexicon_flags(df: DataFrame, text: str = "comment", lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """Add ``is_positive`` / ``is_negative`` (NULL when the text is NULL)."""
    return classified(df, text, lexicon, ["*"])


# Ratings are added up as whole numbers of this share, if every one of a group is a whole number of them.
_RATING_UNIT = 1_000_000


def exact_mean_sql(column: str) -> str:
    """SQL text: the mean of a double column, the same however its rows are partitioned.

    Values of up to six decimals are added up as integers, whose sum does not depend on the order, and the
    sum is divided once. A group with any other value (more decimals, beyond 2**53 units, NaN, infinite), or
    whose integers overflow, takes the plain average.
    """
    x = ident(column)
    units = f"try_cast(round({x} * {_RATING_UNIT}) AS BIGINT)"
    fits = f"({units} IS NOT NULL AND abs({units}) < 9007199254740992 AND CAST({units} AS DOUBLE) / {_RATING_UNIT} = {x})"
    whole = f"try_sum(CASE WHEN {fits} THEN {units} END)"
    other = f"count_if({x} IS NOT NULL AND NOT {fits})"
    return f"CASE WHEN {other} = 0 AND {whole} IS NOT NULL THEN {whole} / {_RATING_UNIT}D / count({x}) ELSE avg({x}) END"


def gold_rollup(
    consolidated: DataFrame,
    lexicon: Lexicon = DEFAULT_LEXICON,
    with_spread: bool = False,
) -> DataFrame:
    """Monthly rollup per app, channel, period and segment.

    ``avg_rating`` is the mean rating rounded to one decimal (NULL ratings
    skipped; see ``exact_mean_sql``); ``n_positive`` / ``n_negative`` count comments that match the
    lexicon. ``with_spread`` adds ``rating_spread_pct``: (max - min) / max in
    percent, two decimals, NULL when max is 0.

    One hash aggregation: partial aggregates per map task, then one shuffle
    on the four keys, whose cardinality is apps x channels x months x
    segments; no global sort (see ``preview``).
    """
    measures = [
        f"round({exact_mean_sql('rating')}, 1) AS avg_rating",
        "count(1) AS n_reviews",
        "count_if(is_positive) AS n_positive",
        "count_if(is_negative) AS n_negative",
    ]
    if with_spread:
        measures.append("round(try_divide(max(rating) - min(rating), max(rating)) * 100, 2) AS rating_spread_pct")
    rows = classified(consolidated, "comment", lexicon, [*GOLD_KEYS, "rating"])
    return rows.groupBy(*GOLD_KEYS).agg(*[F.expr(m) for m in measures])


def display_order(names: dict[str, str] | None = None) -> list[Column]:
    """Newest period first, then app name descending; channel and segment make
    it total. ``names`` maps our column names to the ones in use."""
    n = names or {}
    return [
        F.col(n.get("period", "period")).desc_nulls_last(),
        F.col(n.get("app_name", "app_name")).desc_nulls_last(),
        F.col(n.get("channel", "channel")).asc_nulls_last(),
        F.col(n.get("segment", "segment")).asc_nulls_last(),
    ]


def preview(gold: DataFrame, n: int = 20, names: dict[str, str] | None = None) -> DataFrame:
    """The first ``n`` gold rows in display order (a top-k, not a full sort)."""
    return gold.orderBy(*display_order(names)).limit(n)


def with_original_names(gold: DataFrame) -> DataFrame:
    """Gold columns under the original job's names (for its consumers)."""
    return gold.withColumnsRenamed({k: v for k, v in ORIGINAL_GOLD_NAMES.items() if k in gold.columns})
