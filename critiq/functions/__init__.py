"""Column expressions built from Spark's own functions (no UDFs).

Each builder exists as ``*_sql`` (Spark SQL text, to compose into larger
expressions) and as a Column (``F.expr`` of that text).
"""

from critiq.functions.casts import legacy_int, legacy_int_sql, lenient_double, lenient_double_sql
from critiq.functions.dates import parse_review_ts, parse_review_ts_sql, period_of, period_of_sql
from critiq.functions.text import (
    DEFAULT_LEXICON,
    Lexicon,
    lexicon_flag,
    lexicon_flag_sql,
    lexicon_text_sql,
    negated_pattern,
    word_pattern,
    strip_channel_suffix,
    strip_channel_suffix_sql,
)

__all__ = [
    "DEFAULT_LEXICON",
    "Lexicon",
    "legacy_int",
    "legacy_int_sql",
    "lenient_double",
    "lenient_double_sql",
    "lexicon_flag",
    "lexicon_flag_sql",
    "lexicon_text_sql",
    "negated_pattern",
    "word_pattern",
    "parse_review_ts",
    "parse_review_ts_sql",
    "period_of",
    "period_of_sql",
    "strip_channel_suffix",
    "strip_channel_suffix_sql",
]
