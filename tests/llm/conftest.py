import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_texts import prose  # noqa: E402


@pytest.fixture()
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    rng = random.Random(7)
    one = prose(rng, 80)
    rows = [
        (1, one, "en", "a", 5), (2, None, None, None, None), (3, "", "en", "b", 0), (4, " \n\t", "en", None, 3),
        (5, one, "de", "a", 5), (5, one, "de", "a", 5), (None, one, None, "a", None), (None, None, None, None, None),
        (6, prose(rng, 60_000), "fr", "b", 9), (7, "x" * 50_000, "fr", "b", 9), (8, one + " end", "en", "c", 1),
        (9, "é世\U0001f600 " * 70, "zh", "c", 1), (-1, prose(rng, 120), "en", "a", 2),
    ]
    clash = ["fp", "h", "line", "component", "kind", "l", "s", "size", "copies", "removed", "doc", "d", "t"]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for k, name in enumerate(clash):
        frame = frame.withColumn(name, F.lit(k) if k % 2 else F.lit(None).cast("string"))
    return frame
