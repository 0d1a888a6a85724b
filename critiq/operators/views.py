"""Silver history view: the valid reviews, upper-cased and typed, distinct."""

from __future__ import annotations

from pyspark.sql import DataFrame

from critiq.functions.casts import legacy_int_sql
from critiq.functions.dates import parse_review_ts_sql
from critiq.operators.repeats import distinct_rows

def history_projection(valid: DataFrame) -> DataFrame:
    """title, snippet, app_source, app upper-cased; rating as int; iso_date as a
    TIMESTAMP instant parsed from any of the feeds' formats."""
    return valid.selectExpr(
        "upper(title) AS title",
        "upper(snippet) AS snippet",
        "upper(app_source) AS app_source",
        "upper(app) AS app",
        "segmento",
        f"{legacy_int_sql('rating')} AS rating",
        f"{parse_review_ts_sql('iso_date')} AS iso_date",
    )


def history_view(valid: DataFrame) -> DataFrame:
    """Distinct rows of the history projection. Texts of rows that repeat nothing are not shuffled (see
    ``distinct_rows``): what is, for them, is a 64-bit hash."""
    return distinct_rows(history_projection(valid))
