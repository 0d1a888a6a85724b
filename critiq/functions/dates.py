"""Review timestamps and reporting periods (column name or SQL expression in)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from critiq.functions.sql import string_literal

# Accepted review timestamp texts (fixed formats of the three feeds):
#   2024-03-15T08:00:00Z            UTC designator
#   2024-03-15T08:00:00-07:00       offset with colon
#   2024-03-15T08:00:00-0700        offset without colon
#   2024-03-15T08:00:00.123456      microseconds, no offset: read as UTC
_WITH_ISO_OFFSET = "yyyy-MM-dd'T'HH:mm:ssXXX"
_WITH_BASIC_OFFSET = "yyyy-MM-dd'T'HH:mm:ssZ"
_MICROS_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def parse_review_ts_sql(expr: str) -> str:
    """SQL text: a review timestamp text as a TIMESTAMP instant, NULL if
    unparseable.

    The text's ending picks the one format to try (a failed parse costs an
    exception inside the parser, so formats are not tried blindly); the
    parse itself still validates the whole text and never raises.
    """
    x = expr
    return (
        f"CASE WHEN {x} RLIKE {string_literal('(Z|[+-][0-9]{2}:[0-9]{2})$')} "
        f"THEN try_to_timestamp({x}, {string_literal(_WITH_ISO_OFFSET)}) "
        f"WHEN {x} RLIKE {string_literal('[+-][0-9]{4}$')} "
        f"THEN try_to_timestamp({x}, {string_literal(_WITH_BASIC_OFFSET)}) "
        f"WHEN {x} RLIKE {string_literal('[.][0-9]{6}$')} "
        f"THEN try_to_timestamp(concat({x}, 'Z'), {string_literal(_MICROS_UTC)}) END"
    )


def parse_review_ts(expr: str) -> Column:
    return F.expr(parse_review_ts_sql(expr))


def period_of_sql(expr: str) -> str:
    """SQL text: the reporting period, the first seven characters (``yyyy-MM``)."""
    return f"substring({expr}, 1, 7)"


def period_of(expr: str) -> Column:
    return F.expr(period_of_sql(expr))
