"""The legacy casts equal Spark's own pre-ANSI casts on random inputs.

The reference result is Spark itself: ``CAST(x AS INT)`` analyzed with ANSI
mode off. Our expressions run with ANSI mode on.
"""

import math
import random

from pyspark.sql import types as T

from critiq.functions.casts import legacy_int_of_sql, legacy_int_sql, lenient_double_sql


def _both(spark, df, ours_sql, legacy_sql):
    ours = {r[0]: r[1] for r in df.selectExpr("x", f"{ours_sql} AS v").collect()}
    saved = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        legacy = {r[0]: r[1] for r in df.selectExpr("x", f"{legacy_sql} AS v").collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", saved)
    return ours, legacy


def _same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def test_text_to_int_on_random_strings(spark):
    rnd = random.Random(20240501)
    alphabet = "0123456789+-.  \t\nE1e9\x7f"
    texts = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 9))) for _ in range(4000)}
    texts |= {"2147483647", "2147483648", "-2147483648", "-2147483649", "00012", "+.", "-0", "1.", ".9", "\x00 7 \x1f", "4.0\x7f", "\x7f4.9", "4\x7f"}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "x string")
    ours, legacy = _both(spark, df, legacy_int_sql("x"), "CAST(x AS INT)")
    diff = {k: (ours[k], legacy[k]) for k in ours if ours[k] != legacy[k]}
    assert not diff, list(diff.items())[:10]


def test_text_to_double_on_random_strings(spark):
    rnd = random.Random(7)
    alphabet = "0123456789+-. eEdfxNaInity"
    texts = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(3000)}
    texts |= {"NaN", "Infinity", "-Infinity", " 4.5 ", "1e308", "1e309", "4.0d", "0x1p3", "n/a"}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "x string")
    ours, legacy = _both(spark, df, lenient_double_sql("x"), "CAST(x AS DOUBLE)")
    diff = {k: (ours[k], legacy[k]) for k in ours if not _same(ours[k], legacy[k])}
    assert not diff, list(diff.items())[:10]


def test_numbers_to_int_on_random_values(spark):
    rnd = random.Random(11)
    doubles = [rnd.uniform(-5e9, 5e9) for _ in range(1500)] + [rnd.uniform(-10, 10) for _ in range(1500)]
    doubles += [math.nan, math.inf, -math.inf, 2147483647.9, -2147483648.9, 1e-300, -0.0]
    df = spark.createDataFrame([(d,) for d in doubles], "x double")
    ours, legacy = _both(spark, df, legacy_int_of_sql("x", T.DoubleType()), "CAST(x AS INT)")
    assert all(ours[k] == legacy[k] for k in ours if not (isinstance(k, float) and math.isnan(k)))
    longs = [rnd.randint(-(2**63), 2**63 - 1) for _ in range(3000)] + [2**31, -(2**31) - 1, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in longs], "x bigint")
    ours, legacy = _both(spark, df, legacy_int_of_sql("x", T.LongType()), "CAST(x AS INT)")
    assert ours == legacy
