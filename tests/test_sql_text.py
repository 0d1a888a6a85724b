"""SQL text helpers: literals of every report type survive the round trip."""

from datetime import datetime

from pyspark.sql import Row
from pyspark.sql import types as T

from critiq.functions.sql import ident, literal, string_literal
from critiq.plans.report import one_row


def test_string_literal_escapes(spark):
    tricky = "it's a \\ back\tslash\n\x00end ção"
    got = spark.range(1).selectExpr(f"{string_literal(tricky)} AS s").collect()[0]["s"]
    assert got == tricky


def test_one_row_nested_values(spark):
    schema = T.StructType(
        [
            T.StructField("s", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("i", T.IntegerType()),
            T.StructField("d", T.DoubleType()),
            T.StructField("b", T.BooleanType()),
            T.StructField("arr", T.ArrayType(T.StringType())),
            T.StructField("st", T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.StringType())])),
            T.StructField("ts", T.TimestampType()),
            T.StructField("missing", T.StringType()),
        ]
    )
    pct = 10578 / 10579 * 100
    values = ("a'b", 2**40, 7, pct, True, ["x", "y"], (0.1 + 0.2, None), datetime(2024, 5, 1, 6, 0), None)
    df = one_row(spark, values, schema)
    assert df.schema.simpleString() == schema.simpleString()
    r = df.collect()[0]
    assert r["s"] == "a'b" and r["n"] == 2**40 and r["i"] == 7 and r["b"] is True
    assert r["d"] == pct  # exact double round trip
    assert r["arr"] == ["x", "y"] and r["st"] == Row(x=0.1 + 0.2, y=None)
    assert r["ts"] == datetime(2024, 5, 1, 6, 0) and r["missing"] is None


def test_special_doubles_and_empty_array(spark):
    for v in (float("nan"), float("inf"), -float("inf"), 1e-300, 1.5e300):
        got = spark.range(1).selectExpr(f"{literal(v, T.DoubleType())} AS v").collect()[0]["v"]
        assert (got != got) if v != v else got == v
    got = spark.range(1).selectExpr(f"{literal([], T.ArrayType(T.StringType()))} AS a").collect()[0]["a"]
    assert got == []


def test_ident_quotes_backticks(spark):
    got = spark.range(1).selectExpr(f"1 AS {ident('we`ird name')}").columns
    assert got == ["we`ird name"]


def test_map_literals(spark):
    t = T.MapType(T.StringType(), T.DoubleType())
    got = spark.range(1).selectExpr(f"{literal({'gold': 0.5, 'dedup': 1.25}, t)} AS m", f"{literal({}, t)} AS e").collect()[0]
    assert got["m"] == {"gold": 0.5, "dedup": 1.25} and got["e"] == {}
