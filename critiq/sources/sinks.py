"""Sinks: partitioned Parquet, JSON documents and the append-only run report.

Every write is a distributed Spark write; no row passes through the driver.
"""

from __future__ import annotations

import hashlib
import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from critiq.schema import PARTITION_COLUMN
from critiq.session import move_only_file, remove_path
from critiq.sources import versions

log = logging.getLogger(__name__)


def stamp_run_date(df: DataFrame, run_date: str, column: str = PARTITION_COLUMN) -> DataFrame:
    """Add the run's load date (``YYYYMMDD``) as a literal column."""
    if not (len(run_date) == 8 and run_date.isdigit()):
        raise ValueError(f"run_date must be YYYYMMDD, got {run_date!r}")
    return df.withColumn(column, F.lit(run_date))


def write_partitioned_parquet(
    df: DataFrame,
    path: str,
    run_date: str,
    label: str = "data",
    partition_column: str = PARTITION_COLUMN,
    compression: str = "snappy",
    empty: bool | None = None,
    rebalance: bool = True,
    order: Sequence[Column] = (),
) -> bool:
    """Overwrite the ``<partition_column>=<run_date>`` partition under ``path``.

    Other load dates under ``path`` stay (dynamic partition overwrite), so a
    rerun of one day replaces only that day. An empty frame writes nothing and
    returns False; pass ``empty`` when the caller already knows the row count
    to skip the emptiness probe. ``rebalance`` lets AQE regroup the rows into
    partitions of the advisory size before writing (small ones are joined, large ones split), so the day is not one small file
    for each input partition. ``order`` sorts the rows of each file.
    """
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a DataFrame, got {type(df).__name__}")
    if not path:
        raise ValueError("target path must not be empty")
    stamped = stamp_run_date(df, run_date, partition_column)
    if empty is None:
        empty = stamped.isEmpty()
    if empty:
        log.warning("no %s rows to save at %s", label, path)
        return False
    _write_partitions(stamped.hint("rebalance") if rebalance else stamped, path, partition_column, compression, order)
    log.info("saved %s rows at %s", label, path)
    return True


def _write_partitions(
    df: DataFrame, path: str, partition_column: str, compression: str, order: Sequence[Column]
) -> None:
    if order:
        df = df.sortWithinPartitions(partition_column, *order)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(partition_column)
        .parquet(path)
    )


def write_dated_parquet(
    df: DataFrame,
    path: str,
    partition_column: str = PARTITION_COLUMN,
    compression: str = "snappy",
    order: Sequence[Column] = (),
) -> None:
    """Overwrite the load dates that ``df`` holds (its ``partition_column``), each in files of the advisory size.

    A backfill of many days: rows are dealt by date, AQE joins the small dates' shuffle partitions and splits those of a date
    that holds more than the advisory size, so a hot date becomes several files written by
    several tasks, and no date a file for each input partition. Rows without a date are refused (their folder would
    not be read back as null).
    """
    if partition_column not in df.columns:
        raise ValueError(f"no column {partition_column!r} to partition by")
    dated = F.raise_error(F.lit(f"a row without {partition_column}"))
    checked = df.withColumn(partition_column, F.coalesce(F.col(partition_column).cast("string"), dated))
    _write_partitions(checked.hint("rebalance", partition_column), path, partition_column, compression, order)


def read_partitioned_parquet(
    spark, path: str, partition_column: str = PARTITION_COLUMN, schema: T.StructType | None = None
) -> DataFrame:
    """Read a sink output back with ``odate`` as text (partition discovery
    would type it as a number). With the data ``schema`` known, nothing is
    inferred from file footers."""
    if schema is not None:
        full = T.StructType([f for f in schema.fields if f.name != partition_column])
        full = full.add(partition_column, T.StringType())
        return spark.read.schema(full).parquet(path)
    df = spark.read.parquet(path)
    return df.withColumn(partition_column, F.col(partition_column).cast("string"))


# Timestamps in documents keep microseconds and carry their offset.
DOCUMENT_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_documents(df: DataFrame, path: str, empty: bool | None = None) -> bool:
    """Replace a document collection with the rows of ``df`` as JSON lines.

    Null fields are left out of each document; timestamps keep microseconds.
    An empty frame leaves the previous documents in place and returns False.
    The collection is a versioned folder (``critiq.sources.versions``): the new documents are written to a version of
    their own and become current in one step, when the write has succeeded. So readers (``read_documents``,
    ``documents_path``) always find a whole collection, a failed write leaves the previous one, and one that
    is being read stays until the swap after the next.
    """
    if empty is None:
        empty = df.isEmpty()
    if empty:
        log.warning("collection %s not replaced: no rows", path)
        return False
    spark = df.sparkSession
    number, _ = versions.current(spark, path)
    version = versions.new_version(path)
    try:
        (
            df.write.mode("errorifexists")
            .option("ignoreNullFields", "true")
            .option("timestampFormat", DOCUMENT_TIMESTAMP_FORMAT)
            .json(version)
        )
        versions.publish(spark, path, version.rsplit("/", 1)[1], number)
    except Exception:
        remove_path(spark, version)
        raise
    versions.clean(spark, path, lambda content: {content})
    return True


def documents_path(spark, path: str) -> str:
    """The folder of JSON lines that is the collection ``path`` now."""
    _, version = versions.current(spark, path)
    if version is None:
        raise FileNotFoundError(f"no document collection at {path}")
    return f"{path.rstrip('/')}/{version}"


def read_documents(spark, path: str, schema) -> DataFrame:
    """Read a document collection back with its schema."""
    reader = spark.read.schema(schema).option("timestampFormat", DOCUMENT_TIMESTAMP_FORMAT)
    return reader.json(documents_path(spark, path))


# Columns that a report of each kind must have, and those that must not be null.
REPORT_COLUMNS = {
    "success": ("application_id", "valid_data", "invalid_data", "total_records", "validation_results", "timestamp"),
    "failure": ("timestamp", "job", "error"),
}


def append_report(df: DataFrame, path: str, kind: str = "success", run_key: str | None = None) -> None:
    """Append a report document (one row) to a JSON-lines table.

    ``run_key`` names the run (the daily job gives its application id and run date). A report of a run that
    has one already takes its place, so a retried driver leaves one document: the file's name comes from the key, and
    it gets there by one rename. Without a key every call adds a document.
    Refused: an unknown ``kind``, and a report that lacks one of its kind's columns or has null there.
    """
    if kind not in REPORT_COLUMNS:
        raise ValueError(f"unknown kind of report {kind!r}; known: {', '.join(REPORT_COLUMNS)}")
    missing = [c for c in REPORT_COLUMNS[kind] if c not in df.columns]
    if not missing:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REPORT_COLUMNS[kind]], F.count("*").alias("_rows")).first()
        missing = [c for c in REPORT_COLUMNS[kind] if nulls[c] or not nulls["_rows"]]
    if missing:
        raise ValueError(f"incomplete {kind} report, nothing in: {', '.join(missing)}")
    whole = df.coalesce(1).write.option("ignoreNullFields", "false")
    if run_key is None:
        whole.mode("append").json(path)
        return
    spark = df.sparkSession
    name = f"report-{hashlib.sha256(f'{kind}:{run_key}'.encode()).hexdigest()[:32]}.json"
    draft = f"{path.rstrip('/')}/_draft-{uuid.uuid4().hex[:12]}"
    try:
        whole.json(draft)
        move_only_file(spark, draft, f"{path.rstrip('/')}/{name}")
    finally:
        remove_path(spark, draft)
