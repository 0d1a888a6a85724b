"""Casts with the pre-ANSI ("legacy") semantics the job was written against.

Spark 4 runs with ANSI mode on: ``cast('4.0' as int)`` raises and
``try_cast('4.0' as int)`` is NULL, while the legacy cast truncated it to 4.
These expressions give the legacy result without touching session config.
Each takes a column name or a Spark SQL expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from critiq.functions.sql import string_literal

# Legacy string casts ignore ASCII control characters, DEL included, and blanks at both ends.
_PAD = r"[\x00-\x20\x7f]*"
# Accepted shape: optional sign, digits with an optional fraction, or a bare fraction.
_DECIMAL_TEXT = rf"^{_PAD}[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*){_PAD}$"
_WHOLE_PART = rf"^{_PAD}([+-]?[0-9]*)"
_BARE_FRACTION = rf"^{_PAD}[+-]?[.]"


def legacy_int_sql(expr: str) -> str:
    """SQL text: string to int like the legacy cast (trims, truncates a
    fraction, NULL for exponents, letters or overflow).

    Whole numbers take the plain ``try_cast`` (same parser, same trimming);
    only text it rejects goes through the fraction-truncating path.
    """
    x = f"CAST({expr} AS STRING)"
    return (
        f"CAST(coalesce(try_cast({x} AS INT), "
        f"CASE WHEN {x} RLIKE {string_literal(_DECIMAL_TEXT)} THEN coalesce("
        f"try_cast(nullif(regexp_extract({x}, {string_literal(_WHOLE_PART)}, 1), '') AS INT), "
        f"CASE WHEN {x} RLIKE {string_literal(_BARE_FRACTION)} THEN 0 END) END) AS INT)"
    )


def legacy_int(expr: str) -> Column:
    return F.expr(legacy_int_sql(expr))


def lenient_double_sql(expr: str) -> str:
    """SQL text: string to double, NULL when the text is not a number."""
    return f"try_cast({expr} AS DOUBLE)"


def lenient_double(expr: str) -> Column:
    return F.expr(lenient_double_sql(expr))


_INT_MAX, _INT_MIN = 2147483647, -2147483648


def _wrap_long_to_int(x: str) -> str:
    """Keep the low 32 bits of a BIGINT as a signed INT (no overflow on the way)."""
    low = f"({x} & 4294967295)"
    return f"CAST(CASE WHEN {low} >= 2147483648 THEN {low} - 4294967296 ELSE {low} END AS INT)"


def legacy_int_of_sql(expr: str, dtype: T.DataType) -> str:
    """SQL text: the legacy ``cast(x as int)`` of an ``expr`` of type ``dtype``.

    Text as ``legacy_int_sql``; doubles and floats truncate toward zero,
    saturate at the int range and read NaN as 0; longs keep their low 32
    bits; decimals truncate; booleans give 1 / 0.
    """
    if isinstance(dtype, T.StringType):
        return legacy_int_sql(expr)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return (
            f"CAST(CASE WHEN isnan({expr}) THEN 0 WHEN {expr} >= {_INT_MAX} THEN {_INT_MAX} "
            f"WHEN {expr} <= {_INT_MIN} THEN {_INT_MIN} ELSE CAST({expr} AS INT) END AS INT)"
        )
    if isinstance(dtype, T.LongType):
        return _wrap_long_to_int(expr)
    if isinstance(dtype, T.DecimalType):
        return _wrap_long_to_int(f"try_cast({expr} AS BIGINT)")
    if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
        return f"CAST({expr} AS INT)"
    return f"try_cast({expr} AS INT)"


def legacy_int_of(df, column: str) -> str:
    """``legacy_int_of_sql`` for a column of ``df``, typed from its schema."""
    return legacy_int_of_sql(f"`{column}`", df.schema[column].dataType)
