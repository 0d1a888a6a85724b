"""Spark SQL text helpers.

Expressions are built as Spark SQL text and handed to the JVM in one call
(``F.expr`` / ``selectExpr``): composing them through the Column API costs a
Python-to-JVM round trip per node, which dominated planning time.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import types as T


def string_literal(s: str) -> str:
    """A Spark SQL string literal for ``s`` (backslash escapes, control
    characters as ``\\uXXXX``)."""
    out = []
    for ch in s:
        if ch == "\\":
            out.append("\\\\")
        elif ch == "'":
            out.append("\\'")
        elif ord(ch) < 0x20:
            out.append(f"\\u{ord(ch):04x}")
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def ident(name: str) -> str:
    """A back-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def literal(value, dtype: T.DataType) -> str:
    """SQL text for a (possibly nested) Python value of type ``dtype``."""
    type_sql = dtype.simpleString()
    if value is None:
        return f"CAST(NULL AS {type_sql})"
    if isinstance(dtype, T.StructType):
        if hasattr(value, "asDict"):
            value = value.asDict()
        if isinstance(value, dict):
            value = [value.get(f.name) for f in dtype.fields]
        parts = ", ".join(
            f"{string_literal(f.name)}, {literal(v, f.dataType)}" for v, f in zip(value, dtype.fields)
        )
        return f"named_struct({parts})"
    if isinstance(dtype, T.MapType):
        if not value:
            return f"CAST(map() AS {type_sql})"
        pairs = ", ".join(
            f"{literal(k, dtype.keyType)}, {literal(v, dtype.valueType)}" for k, v in value.items()
        )
        return f"CAST(map({pairs}) AS {type_sql})"
    if isinstance(dtype, T.ArrayType):
        items = ", ".join(literal(v, dtype.elementType) for v in value)
        return f"CAST(array({items}) AS {type_sql})"
    if isinstance(dtype, T.StringType):
        return string_literal(str(value))
    if isinstance(dtype, T.BooleanType):
        return "TRUE" if value else "FALSE"
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return f"CAST({int(value)} AS {type_sql})"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        v = float(value)
        if v != v or v in (float("inf"), float("-inf")):
            word = "NaN" if v != v else ("Infinity" if v > 0 else "-Infinity")
            return f"CAST('{word}' AS {type_sql})"
        return f"CAST({v!r} AS {type_sql})"
    if isinstance(dtype, T.TimestampType) and isinstance(value, datetime):
        return f"TIMESTAMP {string_literal(value.isoformat(sep=' '))}"
    if isinstance(dtype, T.DateType) and isinstance(value, date):
        return f"DATE {string_literal(value.isoformat())}"
    raise TypeError(f"no SQL literal for {type_sql}")
