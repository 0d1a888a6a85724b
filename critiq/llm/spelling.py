"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. A word's form is its near word
of largest count (ties: smallest in code-point order) if that is at least RATIO times its own; its root is
what forms lead to in the end.

The index of a block of words has a bitset over them for each (position, letter). For a word asked, letter by
letter, four bitsets go on together, 64 words an operation: words that agree so far (no error), and words that
agree but for one error: a letter replaced (read at the same position), one more in the indexed word
(positions shifted by one) or one less (shifted back by one). The words of a block are asked together, one row of bitsets each.
Bits stand in the order of count, so the best near word is the lowest bit and the number of near words a bit count;
no pair is ever written.

Blocks: of two near words whose shorter one has m letters, the edit lies behind the first m // 2 letters, which are then equal, or
before the last m - m // 2, which are. So a word is dealt to four groups: as the shorter one (or one of equal length) and as
the longer one, by the first half and by the second half. A pair that agrees in its first half is only counted there. Small groups share a
block; a group above SPLIT_WORDS is dealt out: all its words are indexed in each part, and each part asks its share of them.

Defined cases: null and empty texts have no words; documents that share a doc_id or have none count each (null
is written as nothing before the colon); an empty table gives an empty result; words and texts of any length are taken whole; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.llm.common import shuffle_partitions, sorted_groups, staged, text_bytes

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: Of so many crc32 values one marks a word that loses a letter.
DELETE_EVERY = 31
#: Words of a block, unless a group has more, and words of a group that are asked in one part.
BLOCK_WORDS, SPLIT_WORDS = 1024, 1 << 15
#: Bytes of bitsets that a step works on, and code points of the words of a block.
STEP_BYTES, BLOCK_LETTERS = 1 << 20, 1 << 16
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 200_000


def _letters() -> bytes:
    """Latin-1 letters of runs, A-Z in lower case; any other byte is a space."""
    table = bytearray(b" " * 256)
    for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]:
        table[c] = c + 32 if c <= 90 else c
    return bytes(table)


LETTERS = _letters()


def runs(text: str) -> list[bytes]:
    """The lower-cased runs, a byte for each code point."""
    return text.encode("latin-1", "replace").translate(LETTERS).split()


def words(documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: words are Latin-1 bytes, a byte for each code point, so they sort by code point."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        def rows(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                if not text:
                    continue
                start = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
                for w, n in Counter([w for w in runs(text.decode()) if len(w) >= min_length]).items():
                    h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                    if h % DELETE_EVERY == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < min_length:
                            continue
                    held[w] += n
                if len(held) >= HELD_WORDS:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    found = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class SlicedIndex:
    """Bitsets over the rows of ``codes`` (letters as numbers from 1, padded by zeros; sizes: letters of each row)."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        self.n = len(codes)
        self.width = -(-self.n // 64)
        self.letters = int(codes.max(initial=0)) + 1
        self.codes, self.sizes = codes, sizes
        self.slices: dict[int, np.ndarray] = {}
        self.of_size = {m: self.packed(sizes == m) for m in np.unique(sizes).tolist()}
        self.none = np.zeros(self.width, np.uint64)

    def packed(self, rows: np.ndarray) -> np.ndarray:
        """The last axis of booleans as 64-bit sets."""
        room = np.zeros((*rows.shape[:-1], self.width * 64), bool)
        room[..., : self.n] = rows
        return np.packbits(room, axis=-1, bitorder="little").view("<u8")

    def at(self, position: int) -> np.ndarray:
        """(letter, set): the words with that letter at ``position``."""
        if position not in self.slices:
            inside = position < self.codes.shape[1]
            own = self.codes[:, position] if inside else np.zeros(self.n, self.codes.dtype)
            found = self.packed(own[None, :] == np.arange(self.letters)[:, None])
            found[0] = 0  # the padding is no letter
            self.slices[position] = found
        return self.slices[position]

    def near(self, asked: np.ndarray, half: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length (rows of letter numbers): the sets of indexed words one edit away, and of
        those that agree in the first ``half`` letters."""
        n, m = asked.shape
        agree = np.broadcast_to(self.packed(np.ones(self.n, bool)), (n, self.width)).copy()
        replaced = np.zeros_like(agree)
        longer = np.zeros_like(agree)  # the indexed word has had one more letter
        shorter = np.zeros_like(agree)  # one less
        first = agree
        for i in range(m):
            same, ahead = self.at(i)[asked[:, i]], self.at(i + 1)[asked[:, i]]
            new_replaced = (replaced & same) | (agree & ~same)
            new_longer = (longer | agree) & ahead  # one more letter stands before this one
            if i:
                shorter = shorter & self.at(i - 1)[asked[:, i]]
            shorter |= agree  # this letter is the one that is missing
            agree = agree & same
            replaced, longer = new_replaced, new_longer
            if i + 1 == half:
                first = agree.copy()
        found = replaced & self.of_size.get(m, self.none)
        found |= (longer | agree) & self.of_size.get(m + 1, self.none)
        found |= shorter & self.of_size.get(m - 1, self.none)
        return found, first


def lowest_bit(sets: np.ndarray) -> np.ndarray:
    """Number of the lowest bit of each row; -1 if there is none."""
    word = (sets != 0).argmax(axis=1)
    low = sets[np.arange(len(sets)), word]
    bit = np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    return np.where(low != 0, word * 64 + bit, -1)


def near_words(spark: SparkSession, vocabulary: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``vocabulary`` (word, n) with near words."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = batch.column(0).to_pylist(), batch.column(1)
            out = [], [], []
            for w in word:
                for m in (len(w), len(w) - 1):  # letters of the shorter word of a pair
                    out[0].extend((m, m))
                    out[1].extend((0, 1))
                    out[2].extend((w[: m // 2], w[len(w) - (m - m // 2) :]))
            four = pa.array(np.repeat(np.arange(len(word)), 4))
            columns = [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(0).take(four), n.take(four)], ["m", "side", "half", "word", "n"])

    dealt = vocabulary.select("word", "n").mapInArrow(keys, "m int, side int, half binary, word binary, n long")
    dealt = staged(spark, dealt, "word-halves")
    large = dealt.groupBy("m", "side", "half").agg(F.count("*").alias("size")).where(F.col("size") > SPLIT_WORDS)
    parts = F.expr(f"sequence(0, cast((coalesce(size, 1) - 1) div {SPLIT_WORDS} as int))")
    dealt = dealt.join(large, ["m", "side", "half"], "left").withColumn("parts", F.size(parts)).withColumn("part", F.explode(parts))
    dealt = dealt.select("m", "side", "half", "part", "parts", "word", "n")
    # the shares of a large group go to partitions of their own
    dealt = dealt.repartition(shuffle_partitions(spark), "m", "side", "half", "part")
    dealt = dealt.sortWithinPartitions("m", "side", "half", "part", F.desc("n"), "word")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in sorted_groups(batches, 4):
            m, side, half, part, parts = (batch.column(batch.schema.get_field_index(c)) for c in ("m", "side", "half", "part", "parts"))
            m, side, part, parts = (np.asarray(x) for x in (m, side, part, parts))
            other_half = np.asarray(pc.not_equal(half[1:], half[:-1]))
            new = (m[1:] != m[:-1]) | (side[1:] != side[:-1]) | (part[1:] != part[:-1]) | other_half
            group = np.r_[0, np.cumsum(new)]
            starts = np.r_[0, np.flatnonzero(new) + 1, len(group)]
            at = 0
            while at < len(starts) - 1:  # as many whole groups as a block may hold, of one length and side, or a part of a large one
                a, upto = starts[at], at + 1
                most = min(BLOCK_WORDS, max(1, BLOCK_LETTERS // int(m[a] + 1))) if parts[a] == 1 else 0
                while upto < len(starts) - 1 and starts[upto + 1] - a <= most and all(x[starts[upto]] == x[a] for x in (m, side, parts)):
                    upto += 1
                b = starts[upto]
                yield from _block(batch.slice(a, b - a), group[a:b] - group[a])
                at = upto

    near = dealt.mapInArrow(found, "word binary, n_near long, best_n long, best binary")
    order = F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("w"))
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(order).alias("top")).select(
        "word", "n_near", (-F.col("top.k")).alias("best_n"), F.col("top.w").alias("best")
    )


def _block(rows: pa.RecordBatch, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Near words within the groups (numbers from 0, ascending) of a block of one length and side."""
    column = {c: rows.column(rows.schema.get_field_index(c)) for c in ("m", "side", "part", "parts", "word", "n")}
    m, side, part, parts = (int(column[c][0].as_py()) for c in ("m", "side", "part", "parts"))
    word, n = column["word"].to_pylist(), np.asarray(column["n"])
    order = sorted(range(len(word)), key=lambda i: (-n[i], word[i]))  # bits by count, then by code points
    word, n, group = [word[i] for i in order], n[order], group[order]
    sizes = np.array([len(w) for w in word])
    raw = np.frombuffer(b"".join(w.ljust(m + 1, b"\0") for w in word), np.uint8).reshape(len(word), m + 1)
    known = np.unique(np.r_[np.uint8(0), raw.ravel()])
    codes = np.searchsorted(known, raw)
    index = SlicedIndex(codes, sizes)
    same = index.packed(group[None, :] == np.arange(group.max() + 1)[:, None]) if group.max() else None
    step = max(1, STEP_BYTES // (8 * index.width))
    for length in (m, m + 1):
        own = np.flatnonzero(sizes == length)
        if parts > 1:
            own = own[own % parts == part]
        for at in range(0, len(own), step):
            some = own[at : at + step]
            near, first = index.near(codes[some, :length], m // 2)
            if same is not None:
                near &= same[group[some]]
            if side:  # counted by the first half
                near &= ~first
            if length == m + 1:  # the longer words of this group are pairs of equal length in another
                near &= index.of_size.get(m, index.none)
            count = np.bitwise_count(near).sum(axis=1).astype(np.int64)
            hit = np.flatnonzero(count)
            best = lowest_bit(near[hit])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([word[i] for i in some[hit].tolist()], pa.binary()),
                    pa.array(count[hit]),
                    pa.array(n[best].astype(np.int64)),
                    pa.array([word[i] for i in best.tolist()], pa.binary()),
                ],
                ["word", "n_near", "best_n", "best"],
            )


def variants(spark: SparkSession, documents: DataFrame, ratio: int = RATIO, **how) -> DataFrame:
    """``word, n, form, root, n_near, form_n`` of every word."""
    vocabulary = staged(spark, words(documents, **how), "spelling-words")
    near = near_words(spark, vocabulary).withColumnRenamed("word", "w")
    joined = vocabulary.join(near, F.col("word") == F.col("w"), "left")
    good = F.col("best_n") >= ratio * F.col("n")
    rows = joined.select(
        "word",
        "n",
        F.when(good, F.col("best")).alias("form"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best_n")).alias("form_n"),
    )
    rows = staged(spark, rows, "spelling-forms")
    # counts grow by ``ratio`` with each form, so paths are short; a round doubles what is followed
    leads = rows.where("form is not null").select(F.col("word").alias("a"), F.col("form").alias("b"))
    while True:
        further = leads.select(F.col("a").alias("c"), F.col("b").alias("d"))
        joined = leads.join(further, F.col("b") == F.col("c"), "left")
        leads = staged(spark, joined.select("a", F.coalesce("d", "b").alias("b"), F.col("d").isNotNull().alias("on")), "spelling-roots")
        if leads.where("on").isEmpty():
            break
    text = [F.decode(F.col(c), "ISO-8859-1").alias(c) for c in ("word", "form", "root")]
    roots = leads.select("a", "b")
    whole = rows.join(roots, F.col("word") == F.col("a"), "left").withColumn("root", F.coalesce("b", "word"))
    return whole.select(text[0], "n", text[1], text[2], "n_near", "form_n")
