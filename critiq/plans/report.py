"""Run report, failure report, segment list and row-to-JSON documents.

The counts come from distributed aggregations (``quality_summary``); only
their one-row results reach the driver, where the report row is assembled.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from critiq.functions.sql import ident, literal
from critiq.operators.quality import CHECKS

UNKNOWN_SEGMENT = "UNKNOWN"
NO_SEGMENTS = "NA"
UNKNOWN_CLIENT = "UNKNOWN_CLIENT"


@dataclass(frozen=True)
class RunInfo:
    """Identity and timing of one run; every field is a parameter so that a
    report can be reproduced exactly."""

    application_id: str
    job: str = "gold_aggregate"
    search: str = "all_sources"
    team: str = ""
    project: str = ""
    layer: str = "gold"
    start: datetime = field(default_factory=datetime.now)
    end: datetime | None = None
    timestamp: datetime | None = None


def type_client_sql(segments: str) -> str:
    """SQL aggregate: the distinct non-NULL values of ``segments``, sorted,
    comma-joined and upper-cased; ``NA`` when there are none."""
    items = f"array_sort(collect_set({segments}))"
    return f"CASE WHEN size({items}) = 0 THEN '{NO_SEGMENTS}' ELSE upper(array_join({items}, ',')) END"


def segment_of_sql(column: str = "segmento") -> str:
    """The segment as reported: NULL reads ``UNKNOWN``."""
    return f"coalesce({ident(column)}, '{UNKNOWN_SEGMENT}')"


def segment_list(df: DataFrame, column: str = "segmento") -> DataFrame:
    """One row, ``type_client``: distinct segments (NULL as ``UNKNOWN``), sorted,
    comma-joined and upper-cased; ``NA`` when there are no rows.

    The distinct runs as a grouped aggregate first; only the distinct values,
    bounded by the number of segments, are gathered.
    """
    distinct = df.selectExpr(f"{segment_of_sql(column)} AS s").distinct()
    return distinct.agg(F.expr(f"{type_client_sql('s')} AS type_client"))


def rows_to_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON document string (``json``); NULL fields are left out."""
    return df.selectExpr(f"to_json(struct({', '.join(ident(c) for c in df.columns)})) AS json")


_CHECK_TYPE = T.StructType(
    [
        T.StructField("message", T.StringType()),
        T.StructField("status", T.BooleanType()),
        T.StructField("code", T.IntegerType()),
    ]
)

# Field names and nesting of the run report, as its consumers read them.
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("application_id", T.StringType()),
        T.StructField(
            "owner",
            T.StructType(
                [
                    T.StructField("team", T.StringType()),
                    T.StructField("project", T.StringType()),
                    T.StructField("layer", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "valid_data",
            T.StructType([T.StructField("count", T.LongType()), T.StructField("percentage", T.DoubleType())]),
        ),
        T.StructField(
            "invalid_data",
            T.StructType([T.StructField("count", T.LongType()), T.StructField("percentage", T.DoubleType())]),
        ),
        T.StructField("total_records", T.LongType()),
        T.StructField("total_processing_time", T.StringType()),
        T.StructField(
            "validation_results",
            T.StructType([T.StructField(c, _CHECK_TYPE) for c in CHECKS]),
        ),
        T.StructField("success_count", T.IntegerType()),
        T.StructField("error_count", T.IntegerType()),
        T.StructField("type_client", T.StringType()),
        T.StructField(
            "source",
            T.StructType([T.StructField("app", T.StringType()), T.StructField("search", T.StringType())]),
        ),
        T.StructField(
            "run_ts",
            T.StructType([T.StructField("start_ts", T.StringType()), T.StructField("end_ts", T.StringType())]),
        ),
        T.StructField("timestamp", T.StringType()),
        # Wall seconds per pipeline step (the run's own timing; Spark's event
        # log holds the stage-level metrics).
        T.StructField("steps", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def one_row(spark: SparkSession, values, schema: T.StructType) -> DataFrame:
    """A one-row DataFrame built from SQL literals on the JVM side (no Python
    RDD, so no Python worker is started to serve it)."""
    if isinstance(values, Row):
        values = values.asDict()
    if isinstance(values, dict):
        values = [values.get(f.name) for f in schema.fields]
    return spark.range(0, 1, 1, 1).selectExpr(
        *[f"{literal(v, f.dataType)} AS {ident(f.name)}" for v, f in zip(values, schema.fields)]
    )


def run_report(
    spark: SparkSession,
    summary: Row,
    verdict_rows: list[Row],
    type_client: str,
    run: RunInfo,
    steps: dict[str, float] | None = None,
) -> DataFrame:
    """The one-row run report, put together in SQL.

    ``summary`` is the collected ``quality_summary`` row, ``verdict_rows`` the
    collected ``verdicts``; both must be complete. Total = valid + invalid: rows that are
    in neither set do not count. ``steps`` are the wall seconds of the run's steps, if measured.
    """
    missing = [k for k in ("n_valid", "n_invalid") if summary[k] is None] + [
        c for c in CHECKS if c not in {r["check"] for r in verdict_rows}
    ]
    if missing:
        raise ValueError(f"incomplete run metrics: {', '.join(missing)}")
    end, stamp = run.end or datetime.now(), run.timestamp or datetime.now()
    facts = T.StructType(
        [
            T.StructField("run", T.StructType([T.StructField(k, T.StringType()) for k in ("id", "team", "project", "layer", "job", "search", "t0", "t1", "stamp")])),
            T.StructField("n_ok", T.LongType()),
            T.StructField("n_bad", T.LongType()),
            T.StructField("minutes", T.DoubleType()),
            T.StructField("checks", T.MapType(T.StringType(), _CHECK_TYPE)),
            T.StructField("segments", T.StringType()),
            T.StructField("steps", T.MapType(T.StringType(), T.DoubleType())),
        ]
    )
    values = {
        "run": (
            run.application_id, run.team, run.project, run.layer, run.job, run.search,
            run.start.isoformat(" ", "seconds"), end.isoformat(" ", "seconds"), stamp.isoformat(timespec="milliseconds") + "Z",
        ),
        "n_ok": int(summary["n_valid"]),
        "n_bad": int(summary["n_invalid"]),
        "minutes": (end - run.start).total_seconds() / 60,
        "checks": {r["check"]: (r["message"], bool(r["status"]), int(r["code"])) for r in verdict_rows},
        "segments": type_client,
        "steps": dict(steps) if steps is not None else None,
    }

    def share(part: str) -> str:
        return f"coalesce(try_divide(CAST({part} AS DOUBLE), CAST(n_ok + n_bad AS DOUBLE)), 0D) * 100"

    checks = ", ".join(f"'{c}', checks['{c}']" for c in CHECKS)
    passed = "size(filter(map_values(checks), c -> c.status))"
    columns = {
        "application_id": "run.id",
        "owner": "named_struct('team', run.team, 'project', run.project, 'layer', run.layer)",
        "valid_data": f"named_struct('count', n_ok, 'percentage', {share('n_ok')})",
        "invalid_data": f"named_struct('count', n_bad, 'percentage', {share('n_bad')})",
        "total_records": "n_ok + n_bad",
        "total_processing_time": "concat(CAST(CAST(minutes AS DECIMAL(18, 2)) AS STRING), ' min')",
        "validation_results": f"named_struct({checks})",
        "success_count": passed,
        "error_count": f"size(checks) - {passed}",
        "type_client": "segments",
        "source": "named_struct('app', run.job, 'search', run.search)",
        "run_ts": "named_struct('start_ts', run.t0, 'end_ts', run.t1)",
        "timestamp": "run.stamp",
        "steps": "steps",
    }
    return one_row(spark, values, facts).selectExpr(*[f"{columns[f.name]} AS {ident(f.name)}" for f in REPORT_SCHEMA])


# Field names of the failure document.
FAILURE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("project", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("tower", T.StringType()),
        T.StructField("client", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)


def client_segments(df: DataFrame | None, column: str = "segmento") -> DataFrame | None:
    """Distinct segments of ``df`` as one sorted array (``client``)."""
    if df is None:
        return None
    distinct = df.selectExpr(f"{segment_of_sql(column)} AS s").distinct()
    return distinct.agg(F.expr("array_sort(collect_list(s)) AS client"))


def failure_report(
    spark: SparkSession,
    error: BaseException | str | None,
    run: RunInfo,
    df: DataFrame | None = None,
    priority: str = "0",
    tower: str = "",
) -> DataFrame:
    """The one-row failure document: run identity, the client segments of
    ``df`` (``[UNKNOWN_CLIENT]`` without one, or when they cannot be read) and
    the error text. Without an error there is nothing to report: that is refused."""
    if not str(error or ""):
        raise ValueError("a failure report needs an error")
    clients = [UNKNOWN_CLIENT]
    if df is not None:
        try:
            got = client_segments(df).collect()[0]["client"]
            clients = list(got) if got else clients
        except Exception:  # noqa: BLE001 - the report must still go out
            clients = [UNKNOWN_CLIENT]
    stamp = (run.timestamp or datetime.now()).isoformat()
    row = (
        stamp,
        run.layer,
        run.project,
        run.job,
        priority,
        tower,
        clients,
        str(error),
    )
    return one_row(spark, row, FAILURE_SCHEMA)
