"""Review operators: harmonize, union, dedup, quality, rollup, views."""

from critiq.operators.dedup import dedup_by_key, feed_rank_sql, survivor_order_sql
from critiq.operators.harmonize import harmonize, harmonize_all, union_feeds
from critiq.operators.quality import (
    duplicate_keys,
    duplicate_rows,
    invalid_rows,
    non_numeric_ratings,
    null_counts,
    quality_summary,
    valid_rows,
    validate_ingest,
    verdicts,
)
from critiq.operators.repeats import distinct_rows
from critiq.operators.rollup import (
    PERIOD_PATTERN,
    consolidate,
    display_order,
    exact_mean_sql,
    filter_period,
    gold_rollup,
    lexicon_flags,
    preview,
    with_original_names,
)
from critiq.operators.survivors import SurvivorStore
from critiq.operators.views import history_projection, history_view

__all__ = [
    "PERIOD_PATTERN",
    "SurvivorStore",
    "consolidate",
    "dedup_by_key",
    "display_order",
    "distinct_rows",
    "duplicate_keys",
    "duplicate_rows",
    "exact_mean_sql",
    "feed_rank_sql",
    "filter_period",
    "gold_rollup",
    "harmonize",
    "harmonize_all",
    "history_projection",
    "history_view",
    "invalid_rows",
    "lexicon_flags",
    "non_numeric_ratings",
    "null_counts",
    "preview",
    "quality_summary",
    "survivor_order_sql",
    "union_feeds",
    "valid_rows",
    "validate_ingest",
    "verdicts",
    "with_original_names",
]
