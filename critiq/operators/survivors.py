"""Dedup over history, a day at a time: the survivors of all days so far, kept by key.

The survivors lie in buckets by a hash of the key (``merge_key``: never null, so that the NULL key is one
key like any other). A day's feeds are deduplicated alone; what is left is joined with
the stored buckets that its keys fall into, and of two rows with a key the one that ``dedup_by_key`` would
keep survives. That order is total, so merging day by day gives what one dedup over all days gives, in whatever
order the days come, and merging a day twice changes nothing.

* Only touched buckets are read (partition pruning on ``bucket``) and written; the others stay as they are.
* The store is a bucketed table, so the full outer join needs no shuffle of the stored side: the plan's
  exchanges are all on the day's side. The result is written in the same buckets, again without a shuffle.
* Touched buckets go to a new version folder. One pointer file names the version of every bucket
  (``critiq.sources.versions``), so a reader sees all of a merge or nothing, and a failed merge leaves the store as it was.

The driver holds one short text for each bucket, never keys or rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from critiq.functions.sql import string_literal
from critiq.operators.dedup import dedup_by_key, rank_of_sql, survivor_columns
from critiq.schema import UNIFIED_COLUMNS
from critiq.session import remove_path, scratch_path
from critiq.sources import versions
from critiq.sources.feeds import DEFAULT_FEEDS

#: Buckets of a new store. One bucket of a merge is one task: aim at some 100 MB each.
BUCKETS = 64

# Never null, and another value for each key, the NULL key included.
_MERGE_KEY = "coalesce(concat('=', id), '') AS merge_key"


def _bucket_sql(buckets: int) -> str:
    """The bucket that a bucketed write puts a merge_key into."""
    return f"CAST(pmod(hash(merge_key), {buckets}) AS INT)"


def precedes_sql(a: str, b: str, priority: Sequence[str]) -> str:
    """SQL text: does the row of struct ``a`` come before that of ``b`` in the survivor order?"""
    out = "false"
    for column, ascending in reversed(survivor_columns()):
        x, y = (rank_of_sql(priority, f"{s}.app_source") if column == "app_source" else f"{s}.{column}" for s in (a, b))
        first = f"{x} < {y}" if ascending else f"{x} > {y}"
        out = f"CASE WHEN {x} <=> {y} THEN {out} WHEN {y} IS NULL THEN true WHEN {x} IS NULL THEN false ELSE {first} END"
    return out


@dataclass(frozen=True)
class Merged:
    touched: list[int]  # buckets read and written
    n_buckets: int


class SurvivorStore:
    """The survivors under ``path``. ``buckets`` is fixed when the store is made."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        _, content = versions.current(spark, self.path)
        self.buckets = json.loads(content)["buckets"] if content else buckets

    def _manifest(self) -> tuple[int, dict[int, str]]:
        number, content = versions.current(self.spark, self.path)
        return number, {int(b): v for b, v in json.loads(content)["at"].items()} if content else {}

    def _table(self, at: dict[int, str]) -> str:
        """A catalog name for the buckets in ``at`` (bucket: version). Dropping it would leave the data."""
        name = f"critiq_survivors_{uuid.uuid4().hex}"
        columns = ", ".join(f"{c} STRING" for c in (*UNIFIED_COLUMNS, "merge_key"))
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, bucket INT) USING parquet PARTITIONED BY (bucket) "
            f"CLUSTERED BY (merge_key) INTO {self.buckets} BUCKETS LOCATION {string_literal(self.path + '/_none')}"
        )
        parts = [f"PARTITION (bucket={b}) LOCATION {string_literal(f'{self.path}/{v}/bucket={b}')}" for b, v in sorted(at.items())]
        for i in range(0, len(parts), 500):
            self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts[i : i + 500])}")
        return name

    def _rows(self, at: dict[int, str]) -> DataFrame:
        return self.spark.table(self._table(at))

    def read(self) -> DataFrame:
        """The survivors of all merged days (unified columns), as of now."""
        _, at = self._manifest()
        return self._rows(at).select(*UNIFIED_COLUMNS)

    def joined(self, day: DataFrame, priority: Sequence[str] | None = None) -> tuple[DataFrame, list[int], int]:
        """The merge as a plan: rows (s, d, wins) of the stored and the day's survivor of each key in the touched
        buckets, those buckets, and the pointer it is based on."""
        names = list(priority) if priority is not None else [s.name for s in DEFAULT_FEEDS]
        number, at = self._manifest()
        staged = scratch_path(self.spark, "day")  # the day's feeds are read once
        dedup_by_key(day.select(*UNIFIED_COLUMNS), priority=names).selectExpr("*", _MERGE_KEY).write.parquet(staged)
        fresh = self.spark.read.parquet(staged)
        touched = [r["b"] for r in fresh.selectExpr(f"{_bucket_sql(self.buckets)} AS b").distinct().collect()]  # at most one a bucket
        stored = self._rows({b: at[b] for b in touched if b in at})
        s = stored.selectExpr("merge_key AS s_key", f"struct({', '.join(UNIFIED_COLUMNS)}) AS s")
        d = fresh.repartition(self.buckets, "merge_key").selectExpr("merge_key AS d_key", f"struct({', '.join(UNIFIED_COLUMNS)}) AS d")
        both = s.join(d, s["s_key"] == d["d_key"], "full_outer")
        wins = f"CASE WHEN s IS NULL THEN true WHEN d IS NULL THEN false ELSE {precedes_sql('d', 's', names)} END AS wins"
        return both.selectExpr("coalesce(s_key, d_key) AS merge_key", "s", "d", wins), sorted(touched), number

    def merge(self, day: DataFrame, priority: Sequence[str] | None = None) -> Merged:
        """Merge a day's unified rows into the store and publish the result."""
        both, touched, number = self.joined(day, priority)
        if not touched:
            return Merged([], self.buckets)
        kept = both.selectExpr("merge_key", "if(wins, d, s) AS r")
        rows = kept.selectExpr(*[f"r.{c} AS {c}" for c in UNIFIED_COLUMNS], "merge_key", f"{_bucket_sql(self.buckets)} AS bucket")
        version = versions.new_version(self.path)
        name = f"critiq_survivors_{uuid.uuid4().hex}"
        try:
            rows.write.partitionBy("bucket").bucketBy(self.buckets, "merge_key").option("path", version).saveAsTable(name)
        except Exception:
            remove_path(self.spark, version)
            raise
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay
        _, at = self._manifest()
        at |= dict.fromkeys(touched, version.rsplit("/", 1)[1])
        content = json.dumps({"buckets": self.buckets, "at": {str(b): v for b, v in sorted(at.items())}})
        try:
            versions.publish(self.spark, self.path, content, number)
        except Exception:
            remove_path(self.spark, version)
            raise
        versions.clean(self.spark, self.path, lambda c: set(json.loads(c)["at"].values()))
        return Merged(touched, self.buckets)

    def changes(self, day: DataFrame, priority: Sequence[str] | None = None) -> DataFrame:
        """``change, n_keys``: what merging ``day`` would do to its keys (inserted, replaced, kept)."""
        both, _, _ = self.joined(day, priority)
        kind = "CASE WHEN s IS NULL THEN 'inserted' WHEN wins THEN 'replaced' ELSE 'kept' END AS change"
        return both.where("d IS NOT NULL").selectExpr(kind).groupBy("change").count().withColumnRenamed("count", "n_keys")
