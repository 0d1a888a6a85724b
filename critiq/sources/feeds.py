"""Review feeds: declarative specs and Parquet scans.

A feed is a Parquet directory tree ``<base>/odate=YYYYMMDD/part-*.parquet``.
Its mapping onto the unified review row is data (a ``FeedSpec``), not code,
so adding a feed adds no operator.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from critiq.functions.casts import legacy_int_of
from critiq.functions.sql import string_literal

# Load date in a path: ``odate=`` followed by eight digits.
LOAD_DATE_IN_PATH = r"odate=(\d{8})"


@dataclass(frozen=True)
class FeedSpec:
    """How one feed maps onto the unified review row.

    ``name`` is the value of ``app_source`` for its rows and its rank in
    ``priority`` orders duplicate keys across feeds. ``mapping`` gives, for
    each unified column except ``app_source``, a Spark SQL expression over the
    feed's own columns, or a function of the feed's DataFrame returning one
    (for expressions that depend on a column's type).
    """

    name: str
    mapping: Mapping[str, str | Callable[[DataFrame], str]] = field(default_factory=dict)


def _rating_as_int_text(df: DataFrame) -> str:
    """The rating cast to int and back to text with the legacy cast of its type."""
    return f"CAST({legacy_int_of(df, 'rating')} AS STRING)"


# ---------------------------------------------------------------------------
# The three feed layouts of the original job and their tags.
STORE_A = FeedSpec(
    name="google_play",
    mapping={
        "id": "id",
        "app": "app",
        "segmento": "segmento",
        "rating": _rating_as_int_text,
        "iso_date": "iso_date",
        "title": "title",
        "snippet": "snippet",
    },
)
INTERNAL_DB = FeedSpec(
    name="internal_database_mongodb",
    mapping={
        "id": "id",
        "app": "app",
        "segmento": "segmento",
        "rating": "cast(rating as string)",
        "iso_date": "`timestamp`",
        "title": "comment",
        "snippet": "comment",
    },
)
STORE_B = FeedSpec(
    name="apple_store",
    mapping={
        "id": "id",
        "app": "app",
        "segmento": "segmento",
        "rating": "cast(im_rating as string)",
        "iso_date": "updated",
        "title": "title",
        "snippet": "content",
    },
)
# App name taken from the file path by the original explicit-schema scan
# (layout <base>/googlePlay/<app>/odate=YYYYMMDD/):
STORE_A_APP_FROM_PATH = r"/googlePlay/(.*?)/odate="
# ---------------------------------------------------------------------------

DEFAULT_FEEDS: tuple[FeedSpec, ...] = (STORE_A, INTERNAL_DB, STORE_B)


class EmptyFeedsError(RuntimeError):
    """Raised when every feed is empty: there is nothing to aggregate."""


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    odate_from: str | None = None,
    odate_to: str | None = None,
    base_path: str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Scan a feed directory (or glob). ``odate_from``/``odate_to`` (``YYYYMMDD``,
    inclusive) prune ``odate=`` partitions before any file is opened; without
    them the whole history is read, like the original job.

    ``base_path`` keeps ``odate`` as a column when ``path`` names single day
    folders or a glob below the base; ``merge_schema`` reconciles day folders
    written with different columns (footers of every file are read, so leave
    it off when the schema is stable).
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(*paths)
    if (odate_from or odate_to) and "odate" in df.columns:
        day = F.col("odate").cast("string")
        if odate_from:
            df = df.filter(day >= F.lit(odate_from))
        if odate_to:
            df = df.filter(day <= F.lit(odate_to))
    return df


def with_provenance(df: DataFrame) -> DataFrame:
    """Add ``file_name`` (the file each row came from) and ``odate`` (the load
    date found in that path, ``''`` when there is none)."""
    file_name = F.col("_metadata.file_path")
    return df.withColumn("file_name", file_name).withColumn(
        "odate", F.regexp_extract(file_name, LOAD_DATE_IN_PATH, 1)
    )


def read_feed_with_schema(
    spark: SparkSession,
    schema: T.StructType,
    path: str,
    app_from_path: str | None = None,
    drop: Iterable[str] = ("response",),
    recursive: bool = False,
) -> DataFrame:
    """Scan with a declared schema instead of footer inference.

    ``app_from_path`` is a regex whose first group, applied to each row's file
    path, becomes the ``app`` column (``''`` when it does not match). Columns in
    ``drop`` are removed when present. ``recursive`` reads every file below ``path`` whatever
    its folders are called (no partition columns).
    """
    reader = spark.read.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.parquet(path)
    if app_from_path is not None:
        df = df.withColumn("app", F.regexp_extract(F.col("_metadata.file_path"), app_from_path, 1))
    present = [c for c in drop if c in df.columns]
    return df.drop(*present) if present else df


def feed_row_counts(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every feed in one job: ``(feed, n_rows)``, zero rows included.

    The feeds are tagged, unioned without columns and counted in one global
    aggregate, so each feed is scanned once and only its row-group counts are
    needed.
    """
    if not feeds:
        raise ValueError("no feeds given")
    names = list(feeds)
    tagged = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(i).alias("_feed")) for i, df in enumerate(feeds.values())],
    )
    counts = tagged.agg(
        *[F.count_if(F.col("_feed") == i).alias(f"n{i}") for i in range(len(names))]
    )
    pairs = ", ".join(f"{string_literal(name)}, n{i}" for i, name in enumerate(names))
    return counts.selectExpr(f"stack({len(names)}, {pairs}) as (feed, n_rows)")


def require_rows(counts: DataFrame) -> dict[str, int]:
    """Collect the (tiny, one row per feed) counts; raise when every feed is empty.

    One or two empty feeds are fine.
    """
    per_feed = {r["feed"]: int(r["n_rows"]) for r in counts.collect()}
    if all(n == 0 for n in per_feed.values()):
        detail = ", ".join(f"{k}: {v}" for k, v in per_feed.items())
        raise EmptyFeedsError(f"no data loaded to unify: every feed is empty ({detail})")
    return per_feed
