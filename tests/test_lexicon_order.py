"""The lexicon asks first whether a word is in a text at all."""

import random

from critiq.functions import text
from critiq.functions.sql import string_literal


def test_flags_are_those_of_the_whole_patterns(spark):
    rng = random.Random(9)
    parts = ["bom", "BOM", "ótimo", "não", "NÃO", "ruim", "nunca", " ", " ", "\n", "\r\n", "́", "_", "a", "\U0001d400", "\U0001d7d7", "ı", "İ", "K", "."]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randint(0, 10))),) for _ in range(3000)] + [(None,)]
    lexicon = text.DEFAULT_LEXICON
    cut = f"regexp_replace(t, {string_literal(text.negated_pattern(lexicon.negators))}, ' ')"
    df = spark.createDataFrame(rows, "t string").coalesce(2)
    for words in (lexicon.positive, lexicon.negative):
        whole = f"{cut} RLIKE {string_literal(text.word_pattern(words))}"
        got = df.selectExpr(f"{whole} AS want", f"{text.lexicon_flag_sql('t', words, lexicon.negators)} AS got")
        assert got.where("want").count() > 50
        assert got.where("NOT (want <=> got)").isEmpty()


def test_whole_words_are_sought_only_where_a_word_is(spark):
    """A line of letters without any word took a look at every place's neighbours."""
    df = text.classified(spark.createDataFrame([("x",)], "t string"), "t", text.DEFAULT_LEXICON, ["t"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for words in (text.DEFAULT_LEXICON.positive, text.DEFAULT_LEXICON.negative):
        assert plan.index(text.anywhere_pattern(words)) < plan.index(text.word_pattern(words))
    assert "CASE WHEN" in plan
