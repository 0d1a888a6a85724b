"""critiq: customer-review analytics expressed as Spark DataFrame plans.

Review feeds of differing shape are mapped to one schema, unioned,
deduplicated by key, quality-checked, rolled up per app / channel /
segment / month and published as Parquet, JSON documents and a run
report. Every operator is a DataFrame transformation; Catalyst plans it.

Main entry points (imported on first use)::

    from critiq import run_pipeline, PipelineConfig, Targets, RunInfo, read_feed
"""

from __future__ import annotations

from importlib import import_module

from critiq.schema import UNIFIED_COLUMNS

__version__ = "0.1.0"

_EXPORTS = {
    "run_pipeline": "critiq.plans.pipeline",
    "load_reviews": "critiq.plans.pipeline",
    "validate": "critiq.plans.pipeline",
    "PipelineConfig": "critiq.plans.pipeline",
    "PipelineResult": "critiq.plans.pipeline",
    "Targets": "critiq.plans.pipeline",
    "RunInfo": "critiq.plans.report",
    "read_feed": "critiq.sources.feeds",
    "read_feed_with_schema": "critiq.sources.feeds",
    "FeedSpec": "critiq.sources.feeds",
    "DEFAULT_FEEDS": "critiq.sources.feeds",
    "Lexicon": "critiq.functions.text",
    "DEFAULT_LEXICON": "critiq.functions.text",
    "build_session": "critiq.session",
}

__all__ = ["UNIFIED_COLUMNS", *_EXPORTS]


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'critiq' has no attribute {name!r}")
