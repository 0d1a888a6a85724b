"""Map feeds onto the unified review row and union them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from critiq.functions.sql import string_literal
from critiq.functions.text import CHANNEL_SUFFIX_PATTERN, strip_channel_suffix_sql
from critiq.schema import UNIFIED_COLUMNS
from critiq.sources.feeds import DEFAULT_FEEDS, FeedSpec


def harmonize(df: DataFrame, spec: FeedSpec, suffix_pattern: str = CHANNEL_SUFFIX_PATTERN) -> DataFrame:
    """Project one feed onto the eight unified string columns.

    Only the columns the mapping names are read (the projection prunes the
    scan); ``app`` loses its channel suffixes and ``app_source`` is the feed's
    name.
    """
    missing = [c for c in UNIFIED_COLUMNS[:-1] if c not in spec.mapping]
    if missing:
        raise ValueError(f"feed {spec.name!r} maps no expression for {missing}")
    exprs = []
    for c in UNIFIED_COLUMNS[:-1]:
        m = spec.mapping[c]
        e = f"CAST({m(df) if callable(m) else m} AS STRING)"
        if c == "app":
            e = strip_channel_suffix_sql(e, suffix_pattern)
        exprs.append(f"{e} AS {c}")
    exprs.append(f"{string_literal(spec.name)} AS app_source")
    return df.selectExpr(*exprs)


def union_feeds(frames: Iterable[DataFrame]) -> DataFrame:
    """Union harmonized feeds by column name, keeping duplicates."""
    frames = [f.select(*UNIFIED_COLUMNS) for f in frames]
    if not frames:
        raise ValueError("no feeds to union")
    return reduce(DataFrame.unionByName, frames)


def harmonize_all(
    feeds: Mapping[str, DataFrame], specs: Iterable[FeedSpec] = DEFAULT_FEEDS
) -> DataFrame:
    """Harmonize every feed named in ``feeds`` by its spec and union them."""
    by_name = {s.name: s for s in specs}
    unknown = [n for n in feeds if n not in by_name]
    if unknown:
        raise KeyError(f"no FeedSpec for feeds {unknown}")
    return union_feeds(harmonize(df, by_name[name]) for name, df in feeds.items())
