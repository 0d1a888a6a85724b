"""Sources (feed scans) and sinks (Parquet, JSON documents, report table)."""

from critiq.sources.feeds import (
    DEFAULT_FEEDS,
    INTERNAL_DB,
    STORE_A,
    STORE_A_APP_FROM_PATH,
    STORE_B,
    EmptyFeedsError,
    FeedSpec,
    feed_row_counts,
    read_feed,
    read_feed_with_schema,
    require_rows,
    with_provenance,
)
from critiq.sources.sinks import (
    append_report,
    documents_path,
    read_documents,
    read_partitioned_parquet,
    stamp_run_date,
    write_dated_parquet,
    write_documents,
    write_partitioned_parquet,
)

__all__ = [
    "DEFAULT_FEEDS",
    "INTERNAL_DB",
    "STORE_A",
    "STORE_A_APP_FROM_PATH",
    "STORE_B",
    "EmptyFeedsError",
    "FeedSpec",
    "append_report",
    "documents_path",
    "feed_row_counts",
    "read_documents",
    "read_feed",
    "read_feed_with_schema",
    "read_partitioned_parquet",
    "require_rows",
    "stamp_run_date",
    "with_provenance",
    "write_dated_parquet",
    "write_documents",
    "write_partitioned_parquet",
]
