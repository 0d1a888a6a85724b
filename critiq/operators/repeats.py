"""Rows that repeat, found by a narrow pass, so that the others need not be shuffled.

The narrow pass counts hashes and marks those that occur more than once in a bit map of 2**MARK_BITS bits. The map is a
small table of 64-bit words (at most 2**(MARK_BITS - 6) rows, whatever the input), broadcast to the scan of the whole rows:
a row whose bit is not set certainly repeats nothing. A set bit only says that a row may repeat, so an exact
step (a join with the keys, or a distinct) follows for the few rows that are left. With more repeated hashes than
bits the map lets all rows through, and the exact step does what it would have done without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the map: 2 MB of them, in at most 2**18 words.
MARK_BITS = 24

_WORD, _BITS, _HASH = "_mark_word", "_mark_bits", "_mark_hash"


def _word_sql(h: str, bits: int) -> str:
    return f"shiftrightunsigned({h}, {64 - bits + 6})"


def _bit_sql(h: str, bits: int) -> str:
    return f"shiftleft(1L, CAST(shiftrightunsigned({h}, {64 - bits}) & 63 AS INT))"


def marks(hashes: DataFrame, column: str, bits: int = MARK_BITS) -> DataFrame:
    """The bit map of a column of 64-bit hashes: words that have a bit set, and their bits."""
    words = hashes.selectExpr(f"{_word_sql(column, bits)} AS {_WORD}", f"{_bit_sql(column, bits)} AS _bit")
    return words.groupBy(_WORD).agg(F.bit_or("_bit").alias(_BITS))


def with_mark(df: DataFrame, hash_sql: str, mapped: DataFrame, bits: int = MARK_BITS, unmarked: bool = True) -> DataFrame:
    """``df`` with the boolean ``_marked``: whether the bit of the row's hash is set in the map ``mapped``. The map is
    joined by a broadcast, so no row moves. ``unmarked=False`` leaves out rows whose whole word is empty."""
    how = "left" if unmarked else "inner"
    hashed = df.withColumn(_HASH, F.expr(hash_sql))
    joined = hashed.join(F.broadcast(mapped), F.expr(_word_sql(_HASH, bits)) == F.col(_WORD), how)
    marked = f"coalesce(({_BITS} & {_bit_sql(_HASH, bits)}) != 0, false)"
    return joined.withColumn("_marked", F.expr(marked)).drop(_HASH, _WORD, _BITS)


def distinct_rows(df: DataFrame, bits: int = MARK_BITS) -> DataFrame:
    """The distinct rows of ``df``. Only hashes and rows that may repeat are shuffled (the latter after
    each task has collapsed its own); all others go straight through. Rows are compared as a whole, so equal
    hashes of different rows do no harm."""
    own = "xxhash64({})".format(", ".join(f"`{c}`" for c in df.columns))
    hashes = df.selectExpr(f"{own} AS h").groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    flagged = with_mark(df, own, marks(hashes, "h", bits), bits)
    alone = flagged.where("NOT _marked").drop("_marked")
    return alone.unionByName(flagged.where("_marked").drop("_marked").distinct())
