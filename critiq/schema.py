"""Column layouts shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values (as the original job names them). Unified review row: every feed is mapped onto these eight string columns.
UNIFIED_COLUMNS = (
    "id",
    "app",
    "segmento",
    "rating",
    "iso_date",
    "title",
    "snippet",
    "app_source",
)

UNIFIED_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in UNIFIED_COLUMNS])

# Columns whose nulls fail the null check; a row is valid only if all are set.
CRITICAL_COLUMNS = ("id", "app", "iso_date", "snippet", "app_source")

# The invalid set leaves `snippet` out of its predicate, so a row whose only
# null is the snippet is in neither set (kept for parity, see README).
INVALID_PREDICATE_COLUMNS = ("id", "app", "iso_date", "app_source")

# Gold rollup group keys and measures, in output order.
GOLD_KEYS = ("app_name", "channel", "period", "segment")
GOLD_MEASURES = ("avg_rating", "n_reviews", "n_positive", "n_negative")

# The original job's gold column names, by our column name.
ORIGINAL_GOLD_NAMES = {
    "app_name": "app_nome",
    "channel": "app_source",
    "period": "periodo_referencia",
    "segment": "segmento",
    "avg_rating": "nota_media",
    "n_reviews": "avaliacoes_total",
    "n_positive": "comentarios_positivos",
    "n_negative": "comentarios_negativos",
    "rating_spread_pct": "nota_tendencia",
}

# Consolidated review row used by the rollup.
CONSOLIDATED_COLUMNS = (
    "app_name",
    "channel",
    "segment",
    "rating",
    "review_date",
    "comment",
    "app_version",
    "client_name",
    "period",
)

# Load-date partition column of every Parquet output.
PARTITION_COLUMN = "odate"
