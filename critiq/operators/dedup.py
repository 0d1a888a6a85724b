"""Keep one row per key across all feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from critiq.functions.sql import ident, string_literal
from critiq.sources.feeds import DEFAULT_FEEDS

# Tie-break columns after feed priority and newest date, for a total order.
_TIE_BREAK = ("app", "segmento", "rating", "title", "snippet")


def feed_rank_sql(priority: Sequence[str], column: str = "app_source") -> str:
    """SQL text: 0 for the first feed in ``priority``, 1 for the next, ...; unknown last."""
    return rank_of_sql(priority, ident(column))


def rank_of_sql(priority: Sequence[str], expr: str) -> str:
    """``feed_rank_sql`` of any SQL expression."""
    whens = " ".join(f"WHEN {string_literal(n)} THEN {i}" for i, n in enumerate(priority))
    return f"CASE {expr} {whens} ELSE {len(priority)} END"


def survivor_columns() -> list[tuple[str, bool]]:
    """Columns of the survivor order, and whether their smallest value comes first (nulls come last).
    ``app_source`` stands for its rank."""
    return [("app_source", True), ("iso_date", False), *[(c, True) for c in _TIE_BREAK]]


def survivor_order_sql(priority: Sequence[str]) -> str:
    """Which row of a key survives: earlier feed, then newest date, then the
    smallest remaining values. Deterministic, so reruns pick the same row."""
    parts = [f"{feed_rank_sql(priority)} ASC", "iso_date DESC NULLS LAST"]
    parts += [f"{c} ASC NULLS LAST" for c in _TIE_BREAK]
    return ", ".join(parts)


def dedup_by_key(
    df: DataFrame,
    key: str = "id",
    priority: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``key`` value; all NULL keys form a single group.

    ``row_number() = 1`` over the key lets Catalyst plan a partial
    WindowGroupLimit before the shuffle: every map task keeps at most one row
    per key, so a key holding a third of all rows (NULL included) still sends
    one row per task to its reducer.
    """
    names = list(priority) if priority is not None else [s.name for s in DEFAULT_FEEDS]
    rn = f"row_number() OVER (PARTITION BY {ident(key)} ORDER BY {survivor_order_sql(names)}) AS _rn"
    return df.selectExpr("*", rn).where("_rn = 1").drop("_rn")
