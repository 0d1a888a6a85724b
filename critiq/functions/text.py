"""Lexicon matching and app-name clean-up."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from critiq.functions.sql import ident, string_literal

# ---------------------------------------------------------------------------
# Fixed values (must equal the original job's for equal results).
# Positive words, negative words and negators of the review lexicon:
POSITIVE_WORDS = ("ótimo", "excelente", "bom")
NEGATIVE_WORDS = ("ruim", "péssimo", "horrível")
NEGATORS = ("não", "nem", "nunca", "jamais")
# Channel suffixes removed anywhere in an app name:
CHANNEL_SUFFIX_PATTERN = "_pf|_pj"
# ---------------------------------------------------------------------------

# Whole-word matching, spelled out instead of \b so the result does not
# depend on the JVM's \b: a word character is a letter, a decimal digit or
# '_'; a non-spacing mark also counts when a letter or digit precedes it
# (through further marks), as in Unicode-aware \b.
_BREAKS = r"\n\r\x85\u2028\u2029"
# Before a word: the line's start, no word character, or marks that rest on
# neither a letter nor a digit. These are consumed, so any number of stacked
# marks is one step.
_START = r"(?:^|[^\p{{L}}\p{{Nd}}\p{{Mn}}_{x}]|(?:^|[^\p{{L}}\p{{Nd}}\p{{Mn}}{x}])\p{{Mn}}+)"
_WORD_START = _START.format(x="")
_WORD_START_IN_LINE = _START.format(x=_BREAKS)
# After a word (which ends in a letter): any mark rests on that letter.
_WORD_END = r"(?![\p{L}\p{Nd}\p{Mn}_])"


@dataclass(frozen=True)
class Lexicon:
    """Word lists for the positive / negative comment counts.

    A comment matches a list when, on one of its lines, a word of the list
    occurs as a whole word (case-insensitive, Unicode-aware) with no negator
    after it on that same line.
    """

    positive: tuple[str, ...] = POSITIVE_WORDS
    negative: tuple[str, ...] = NEGATIVE_WORDS
    negators: tuple[str, ...] = NEGATORS


DEFAULT_LEXICON = Lexicon()


def _alternation(words: tuple[str, ...]) -> str:
    if not words:
        raise ValueError("a lexicon word list must not be empty")
    return "|".join(re.escape(w) for w in words)


def word_pattern(words: tuple[str, ...]) -> str:
    """Java regex: a whole word of ``words``, somewhere."""
    return f"(?ium){_WORD_START}(?:{_alternation(words)}){_WORD_END}"


def anywhere_pattern(words: tuple[str, ...]) -> str:
    """Java regex: ``words`` anywhere, whole or not. A text without it has none of them as a word, and it is
    found faster than a whole word, so it is asked first."""
    return f"(?iu)(?:{_alternation(words)})"


def has_word_sql(expr: str, words: tuple[str, ...]) -> str:
    """SQL text: is one of ``words`` a word of the text (NULL text -> NULL)."""
    return f"({expr} RLIKE {string_literal(anywhere_pattern(words))} AND {expr} RLIKE {string_literal(word_pattern(words))})"


def negated_pattern(negators: tuple[str, ...]) -> str:
    """Java regex: each line's beginning, up to and with its last negator.

    ``.`` does not cross line terminators and the negator's start excludes them.
    """
    return f"(?ium)^.*{_WORD_START_IN_LINE}(?:{_alternation(negators)}){_WORD_END}"


def lexicon_text_sql(expr: str, negators: tuple[str, ...]) -> str:
    """SQL text: the text without what a negator on the same line follows.

    One pass over each line. What is left of a line comes after its last negator,
    so a listed word in it has no negator after it. Both lists are matched
    against this text.
    """
    cut = f"regexp_replace({expr}, {string_literal(negated_pattern(negators))}, ' ')"
    return f"CASE WHEN {expr} RLIKE {string_literal(anywhere_pattern(negators))} THEN {cut} ELSE {expr} END"


def _checked(words: tuple[str, ...], negators: tuple[str, ...]) -> tuple[str, ...]:
    """``words``. A word that is itself a negator is rejected: cutting through it would hide it."""
    both = {w.lower() for w in words} & {n.lower() for n in negators}
    if both:
        raise ValueError(f"words that are also negators: {sorted(both)}")
    return words


def lexicon_flag_sql(expr: str, words: tuple[str, ...], negators: tuple[str, ...]) -> str:
    """SQL text: does the text match the lexicon list (NULL text -> NULL)."""
    return has_word_sql(f"({lexicon_text_sql(expr, negators)})", _checked(words, negators))


# What is left of a text once its negated parts are cut (``classified``).
_LEFT = "_text_left"


def classified(df: DataFrame, text: str, lexicon: Lexicon, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` (SQL) of ``df`` with ``is_positive`` / ``is_negative`` of the column ``text``, in one pass.

    The text is cut once for each row, in a projection of its own below the two tests. Since both use
    it, Catalyst keeps that projection and does not copy the cut into them, or into an aggregate above.
    """
    cut = df.selectExpr(*keep, f"{lexicon_text_sql(ident(text), lexicon.negators)} AS {_LEFT}")
    names = [c for c in cut.columns if c != _LEFT]
    return cut.selectExpr(
        *map(ident, names),
        f"{has_word_sql(_LEFT, _checked(lexicon.positive, lexicon.negators))} AS is_positive",
        f"{has_word_sql(_LEFT, _checked(lexicon.negative, lexicon.negators))} AS is_negative",
    )


def lexicon_flag(expr: str, words: tuple[str, ...], negators: tuple[str, ...]) -> Column:
    return F.expr(lexicon_flag_sql(expr, words, negators))


def strip_channel_suffix_sql(expr: str, pattern: str = CHANNEL_SUFFIX_PATTERN) -> str:
    """SQL text: remove channel suffixes (``_pf`` / ``_pj``) anywhere in an app name."""
    return f"regexp_replace({expr}, {string_literal(pattern)}, '')"


def strip_channel_suffix(expr: str, pattern: str = CHANNEL_SUFFIX_PATTERN) -> Column:
    return F.expr(strip_channel_suffix_sql(expr, pattern))
