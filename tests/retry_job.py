"""Run in its own process (tests/test_retries.py): a session whose tasks may
be retried, and a write whose first attempt of one partition fails after the
observed metrics have already seen rows."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from critiq.operators import dedup_by_key  # noqa: E402
from critiq.operators.quality import summary_aggregates  # noqa: E402
from critiq.session import build_session  # noqa: E402


@F.udf(T.BooleanType())
def fail_first_attempt(_):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True


def main() -> None:
    spark = build_session("local[4,3]", shuffle_partitions=4, extra={"spark.sql.adaptive.enabled": "false"})
    n = 20_000
    rows = spark.range(0, n, 1, 4).selectExpr(
        "CAST(id % 5000 AS STRING) AS id", "'app' AS app", "'pf' AS segmento",
        "CAST(id % 7 AS STRING) AS rating", "'2024-01-01T00:00:00Z' AS iso_date",
        "'t' AS title", "CASE WHEN id % 10 = 0 THEN NULL ELSE 's' END AS snippet",
        "'google_play' AS app_source",
    )
    metrics = Observation("m")
    out = tempfile.mkdtemp(prefix="critiq-retry-")
    (
        dedup_by_key(rows)
        .observe(metrics, *summary_aggregates())
        .where(fail_first_attempt(F.col("id")))
        .write.mode("overwrite").parquet(out)
    )
    truth = dedup_by_key(rows).agg(*summary_aggregates()).collect()[0].asDict()
    print(json.dumps({"observed": metrics.get, "truth": truth}))
    spark.stop()


if __name__ == "__main__":
    main()
