"""Edge cases of the column functions (FIXTURES.md section 4)."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from critiq.functions import DEFAULT_LEXICON, legacy_int, lenient_double, lexicon_flag, parse_review_ts, period_of
from critiq.functions.text import strip_channel_suffix


def one_col(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {type_}")


def test_legacy_int_matches_pre_ansi_cast(spark):
    cases = {
        "5": 5, "4.0": 4, "4.9": 4, " 3 ": 3, ".5": 0, "abc": None, "": None,
        "1e2": None, "99999999999": None, None: None, "-2.7": -2, "+8": 8,
        "\t7\n": 7, "5.": 5, ".": 0, "-.": 0, "+": None, "-": None, "1 2": None,
        "2147483647": 2147483647, "2147483648": None, "-2147483648": -2147483648,
    }
    df = one_col(spark, list(cases))
    got = {r["x"]: r["y"] for r in df.select("x", legacy_int("x").alias("y")).collect()}
    assert got == cases


def test_lenient_double(spark):
    df = one_col(spark, ["4.0", "n/a", "3", None, "1e2"])
    got = [r[0] for r in df.select(lenient_double("x")).collect()]
    assert got == [4.0, None, 3.0, None, 100.0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("muito bom", True),
        ("ÓTIMO", True),
        ("bom mas não", False),
        ("não é bom", True),
        ("bom não, bom", True),
        ("bombom", False),
        ("bom NÃO", False),
        ("Excelente app", True),
        ("bom\nnão gostei", True),  # the negator is on another line
        ("nada\nbom mas nunca", False),
        ("bom_", False),  # '_' is a word character
        ("(bom)", True),
    ],
)
def test_positive_lexicon(spark, text, expected):
    lex = DEFAULT_LEXICON
    df = one_col(spark, [text])
    got = df.select(lexicon_flag("x", lex.positive, lex.negators)).collect()[0][0]
    assert got is expected


def test_negative_lexicon_and_null(spark):
    lex = DEFAULT_LEXICON
    df = one_col(spark, ["app péssimo", "HORRÍVEL demais", "não é ruim", "ruim nunca", None])
    got = [r[0] for r in df.select(lexicon_flag("x", lex.negative, lex.negators)).collect()]
    assert got == [True, True, True, False, None]


def test_review_timestamps_are_instants(spark):
    texts = [
        "2024-03-15T08:00:00Z",
        "2024-03-15T01:00:00-07:00",
        "2024-03-15T01:00:00-0700",
        "2024-03-15T08:00:00.123456",
        "2024-03-15 08:00:00",
        "garbage",
        None,
    ]
    df = one_col(spark, texts).select(F.unix_micros(parse_review_ts("x")).alias("us"))
    got = [r["us"] for r in df.collect()]
    base = int(datetime(2024, 3, 15, 8, tzinfo=timezone.utc).timestamp()) * 1_000_000
    assert got == [base, base, base, base + 123456, None, None, None]


def test_review_timestamps_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = one_col(spark, ["2024-03-15T08:00:00Z", "2024-03-15T08:00:00.000001"])
        got = [r[0] for r in df.select(F.unix_micros(parse_review_ts("x"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    base = int(datetime(2024, 3, 15, 8, tzinfo=timezone.utc).timestamp()) * 1_000_000
    assert got == [base, base + 1]


def test_period_and_suffix(spark):
    df = spark.createDataFrame([("2024-03-15T08:00:00Z", "app_pf_x_pj")], "d string, a string")
    row = df.select(period_of("d").alias("p"), strip_channel_suffix("a").alias("a")).collect()[0]
    assert (row["p"], row["a"]) == ("2024-03", "app_x")


def test_explicit_boundaries_equal_unicode_word_boundary_on_documents(spark):
    """On this JVM (Java 17: Unicode-aware \\b, as the original job ran on) the
    cut text and the explicit boundaries give the same flag for every document."""
    from critiq.sources.testbed import DATA_LEXICON, table

    lex = DATA_LEXICON
    words, negs = "|".join(lex.positive), "|".join(lex.negators)
    java_b = rf"(?iu)\b({words})\b(?!.*\b({negs})\b)"
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    flags = docs.select(F.col("text").rlike(java_b).alias("java"), lexicon_flag("text", lex.positive, lex.negators).alias("ours"))
    got = flags.selectExpr("count_if(java != ours) AS diff", "count_if(ours) AS hits").first()
    assert got["diff"] == 0
    assert got["hits"] > 0


def test_stacked_marks_and_long_lines(spark):
    import time

    lex = DEFAULT_LEXICON
    texts = ["a" + "\u0301" * k + "bom" for k in range(9)] + ["_" + "\u0301" * k + "bom" for k in range(9)]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    java_b = r"(?iu)\b(ótimo|excelente|bom)\b"
    rows = df.select(lexicon_flag("x", lex.positive, lex.negators), F.col("x").rlike(java_b)).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows]
    for tail in ("não", "sim"):
        line = "muito bom isso " * 17_000 + tail
        one = spark.createDataFrame([(line,)], "x string")
        one.select(lexicon_flag("x", lex.positive, lex.negators)).collect()
        t0 = time.perf_counter()
        assert one.select(lexicon_flag("x", lex.positive, lex.negators)).collect()[0][0] == (tail == "sim")
        assert time.perf_counter() - t0 < 1.5
    with pytest.raises(ValueError):
        lexicon_flag("x", ("bom", "Nem"), ("nem",))


def test_legacy_int_follows_the_input_type(spark):
    from critiq.functions.casts import legacy_int_of_sql
    from pyspark.sql import types as T

    cases = [
        ("CAST('NaN' AS DOUBLE)", T.DoubleType(), 0),
        ("3e9D", T.DoubleType(), 2147483647),
        ("-3e9D", T.DoubleType(), -2147483648),
        ("4.7D", T.DoubleType(), 4),
        ("-4.7D", T.DoubleType(), -4),
        ("CAST('Infinity' AS DOUBLE)", T.DoubleType(), 2147483647),
        ("1e-5D", T.DoubleType(), 0),
        ("CAST(4.9 AS FLOAT)", T.FloatType(), 4),
        ("3000000000L", T.LongType(), -1294967296),
        ("-3000000000L", T.LongType(), 1294967296),
        ("4.7BD", T.DecimalType(2, 1), 4),
        ("TRUE", T.BooleanType(), 1),
        ("'4.9'", T.StringType(), 4),
        ("CAST(NULL AS DOUBLE)", T.DoubleType(), None),
    ]
    exprs = [f"{legacy_int_of_sql(e, t)} AS c{i}" for i, (e, t, _) in enumerate(cases)]
    row = spark.range(1).selectExpr(*exprs).collect()[0]
    assert [row[f"c{i}"] for i in range(len(cases))] == [want for _, _, want in cases]


def test_lexicon_on_random_texts_equals_unicode_word_boundaries_and_the_oracle(spark):
    """Random texts of words, accents, combining marks, digits, '_' and line
    breaks: our pattern equals Java's Unicode-aware \\b pattern (this JVM,
    Java 17) and the DuckDB statement used by the oracles."""
    import random

    import duckdb

    from critiq.plans.oracles import lexicon_match

    rnd = random.Random(3)
    pieces = ["bom", "BOM", "ótimo", "não", "nem", " ", ",", ".", "\n", "a", "é", "_", "1", "́", "x", "Ó", "²"]
    texts = sorted({"".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 8))) for _ in range(6000)})
    words, negs = ("ótimo", "excelente", "bom"), ("não", "nem", "nunca", "jamais")
    java_b = r"(?iu)\b(" + "|".join(words) + r")\b(?!.*\b(" + "|".join(negs) + r")\b)"
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = df.select(
        "i", lexicon_flag("x", words, negs).alias("ours"), F.col("x").rlike(java_b).alias("java")
    ).collect()
    con = duckdb.connect()
    con.execute("create table t(i int, x varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(texts)))
    oracle = dict(con.execute(f"select i, {lexicon_match('x', words, negs)} from t").fetchall())
    assert [r["i"] for r in got if r["ours"] != r["java"]] == []
    assert [r["i"] for r in got if r["ours"] != oracle[r["i"]]] == []
    assert 0 < sum(r["ours"] for r in got) < len(got)
