"""The three feed shapes, derived by Spark from the shared test tables.

The original job reads three review feeds; the test tables hold no reviews,
so each feed is a projection of one of them (FIXTURES.md section 2):

* store feed A   <- ``documents`` left join ``labels``
* internal feed  <- ``conversations`` (every turn)
* store feed B   <- ``events``

Everything is lazy; the work grows with the tables. ``write_landing_zone``
lays the feeds out on disk in the job's ``<feed>/odate=YYYYMMDD/`` layout for
the scan and sink operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.functions.text import Lexicon
from critiq.sources.feeds import DEFAULT_FEEDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _month(x: str) -> str:
    return f"lpad(CAST(1 + {x} % 6 AS STRING), 2, '0')"


def store_feed_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns: id, app, segmento, rating (double), iso_date (``...Z``), title, snippet."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left").selectExpr(
        "CASE WHEN doc_id % 211 = 7 THEN NULL ELSE CAST(doc_id AS STRING) END AS id",
        "CASE WHEN doc_id % 59 = 8 THEN NULL ELSE concat(source, '_pf') END AS app",
        "CASE WHEN doc_id % 43 = 9 THEN NULL ELSE lang END AS segmento",
        "CAST(1 + 3 * quality + toxic AS DOUBLE) AS rating",
        "CASE WHEN doc_id % 37 = 4 THEN NULL WHEN doc_id % 41 = 6 THEN 'unknown date' "
        f"ELSE concat('2024-', {_month('doc_id')}, '-15T08:00:00Z') END AS iso_date",
        "concat('reader ', CAST(doc_id % 97 AS STRING)) AS title",
        "CASE WHEN doc_id % 53 = 5 THEN NULL ELSE text END AS snippet",
    )


def internal_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns: id, app, segmento, rating (text), timestamp (microseconds), comment."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "concat('c', CAST(conv_id AS STRING)) AS id",
        "concat('src', CAST(conv_id % 20 AS STRING), '_pj') AS app",
        "CASE WHEN conv_id % 2 = 0 THEN 'pf' ELSE 'pj' END AS segmento",
        "CASE WHEN conv_id % 17 = 3 THEN 'n/a' ELSE concat(CAST(1 + turn % 5 AS STRING), '.0') END AS rating",
        f"concat('2024-', {_month('conv_id')}, '-03T10:20:30.123456') AS `timestamp`",
        "text AS comment",
    )


# Events that become one review under many ids, at one instant written in two ways.
_COPY = "event_id % 23 = 5"


def store_feed_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns: id, app, segmento, im_rating, updated (``-0700`` offset), title, content."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id + 500 AS STRING) AS id",
        f"CASE WHEN {_COPY} THEN 'src7' ELSE concat('src', CAST(user_id % 20 AS STRING)) END AS app",
        f"CASE WHEN {_COPY} THEN 'view' ELSE event_type END AS segmento",
        f"CASE WHEN {_COPY} THEN '4' ELSE CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS STRING) END AS im_rating",
        f"CASE WHEN {_COPY} THEN concat('2024-03-01T09:00:00', CASE WHEN event_id % 2 = 0 THEN 'Z' ELSE '+00:00' END) "
        "ELSE concat(replace(substring(CAST(ts AS STRING), 1, 19), ' ', 'T'), '-0700') END AS updated",
        f"CASE WHEN {_COPY} THEN 'again' ELSE event_type END AS title",
        f"CASE WHEN {_COPY} THEN 'the very same review' ELSE props END AS content",
    )


def derived_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw feeds keyed by the name of their ``FeedSpec`` (job order)."""
    builders = (store_feed_a, internal_feed, store_feed_b)
    return {spec.name: build(spark, sf_dir) for spec, build in zip(DEFAULT_FEEDS, builders)}


# Column of each raw feed that carries the review date text.
_DATE_COLUMN = {"google_play": "iso_date", "internal_database_mongodb": "timestamp", "apple_store": "updated"}


def load_date_of(feed_name: str) -> Column:
    """The ``YYYYMMDD`` load date used to lay a raw test feed out on disk; undated rows go to 19700101."""
    date = f"`{_DATE_COLUMN[feed_name]}`"
    return F.expr(f"CASE WHEN {date} LIKE '2024%' THEN replace(substring({date}, 1, 10), '-', '') ELSE '19700101' END")


def write_landing_zone(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Write the raw test feeds as ``<root>/<feed>/odate=YYYYMMDD/*.parquet``.

    Returns the base path of every feed. Each feed is one distributed write;
    nothing passes through the driver.
    """
    paths = {}
    for name, df in derived_feeds(spark, sf_dir).items():
        path = f"{root.rstrip('/')}/{name}"
        (
            df.withColumn("odate", load_date_of(name))
            .write.mode("overwrite")
            .partitionBy("odate")
            .parquet(path)
        )
        paths[name] = path
    return paths


# Lexicon for the test tables: their invented prose has none of the job's
# Portuguese words, so these checked English words exercise the same matching.
DATA_LEXICON = Lexicon(
    positive=("that", "this", "pour", "und"),
    negative=("worthless", "idiot", "stupid"),
    negators=("from", "with"),
)
