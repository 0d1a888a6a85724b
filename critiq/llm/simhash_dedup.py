"""SimHash near-dedup with pigeonring filtering.

A document's fingerprint has bit b set if more than half of its word shingles'
64-bit hashes have it set. Fingerprints at most ``max_bits`` bits apart are linked
and documents joined by links form a component.

Pigeonring: cut the 64 bits into m = max_bits + 1 segments in a ring. If two
fingerprints differ in at most max_bits bits, some segment starts a chain in which, for
every l, the first l segments differ in at most floor(l * max_bits / m) bits: none in the first, one in
the first two, two in the first three, and so on. So candidates
need only be sought among fingerprints that agree on a segment and share part of
the next two: with both halves of the second equal (it differs in 0 bits), or one half of
the second and one half of the third (at most one bit in each). Each of those
choices is a bucket key, about 26 bits of 64 for 4 bits' distance. In a bucket a
pair must pass the whole chain, then the full Hamming check.

A bucket is searched breadth first: a fingerprint is compared only with those not
yet reached, and each one reached is linked once. So near copies by the thousand
give a bucket one link each, not one for each pair, and no component is cut: whatever a
reached fingerprint is near to was compared with it or already in its component. A
bucket holds distinct fingerprints that agree in its key's bits, 8 bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from critiq.llm.common import shuffle_partitions, sorted_groups, staged, text_bytes
from critiq.llm.components import components
from critiq.operators.repeats import marks, with_mark

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
BITS = 64


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: A-Z lower-cased, ASCII white space parts
    words. Fewer words than a shingle: one shingle of all; none: zero."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle_words + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: n - 1].tolist()]
    ends = (ends[len(words) - n :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends, strict=True)], "<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 14):
        block = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's bits as a signed long) of every row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle_words) for t in text_bytes(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, "doc_id long, fp long")


def _mask(low: int, high: int) -> int:
    return (1 << high) - (1 << low)


def segments(max_bits: int) -> list[int]:
    """Masks of max_bits + 1 segments of about equal width."""
    cuts = [round(BITS * k / (max_bits + 1)) for k in range(max_bits + 2)]
    return [_mask(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def _halves(mask: int) -> tuple[int, int]:
    low, high = (mask & -mask).bit_length() - 1, mask.bit_length()
    return _mask(low, (low + high) // 2), _mask((low + high) // 2, high)


def chain(start: int, max_bits: int) -> list[tuple[int, int]]:
    """(mask of the first l segments from ``start``, bits they may differ in), l = 1, 2, ..."""
    parts, out, mask = segments(max_bits), [], 0
    for k in range(len(parts)):
        mask |= parts[(start + k) % len(parts)]
        out.append((mask, (k + 1) * max_bits // len(parts)))
    return out


def bucket_masks(max_bits: int) -> list[tuple[int, int]]:
    """(start segment, mask of the bits that a bucket's fingerprints share)."""
    parts = segments(max_bits)
    if max_bits < 1:
        return [(0, _mask(0, BITS))]
    out = []
    for i, first in enumerate(parts):
        second = parts[(i + 1) % len(parts)]
        if len(parts) == 2:  # the second may differ in one bit: one half of it is equal
            out += [(i, first | h) for h in _halves(second)]
            continue
        third = parts[(i + 2) % len(parts)]
        out.append((i, first | second))
        out += [(i, first | a | b) for a in _halves(second) for b in _halves(third)]
    return out


def near(one: np.uint64, others: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Which of ``others`` pass the chain and with its last step, all segments, the Hamming check."""
    apart = others ^ one
    found = np.arange(len(others))
    for mask, most in steps:
        found = found[np.bitwise_count(apart[found] & np.uint64(mask)) <= most]
    return found


def bucket_links(members: np.ndarray, steps: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.uint64]]:
    """Links that join what is near in one bucket of distinct fingerprints: (others, one)."""
    rest = members
    while len(rest) > 1:
        frontier, rest = [rest[:1]], rest[1:]
        while frontier and len(rest):
            level = frontier.pop()
            for k in range(len(level)):
                hit = near(level[k], rest, steps)
                if len(hit):
                    yield rest[hit], level[k]
                    frontier.append(rest[hit])
                    rest = np.delete(rest, hit)
                    if not len(rest):
                        break


def fingerprint_links(spark: SparkSession, distinct_fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: links that join all fingerprints (one long column, distinct) at most
    ``max_bits`` apart. One shuffle of narrow rows, (5 * segments) for each fingerprint."""
    masks = bucket_masks(max_bits)
    names = ["c", "k", "fp"]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column(0)).view(np.uint64)
            for c, (_, mask) in enumerate(masks):
                k = (fp & np.uint64(mask)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), c, np.int16)), pa.array(k), batch.column(0)], names
                )

    steps = [chain(start, max_bits) for start, _ in masks]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sorted_groups(batches, 2):
            c, k, fp = (np.asarray(batch.column(i)) for i in range(3))
            edge = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
            starts, ends = np.r_[0, edge], np.r_[edge, len(c)]
            many = ends - starts > 1
            fp, a, b = fp.view(np.uint64), [], []
            for s, e in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
                for others, one in bucket_links(fp[s:e], steps[c[s]]):
                    a.append(others)
                    b.append(np.full(len(others), one))
            if a:
                pair = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]
                yield pa.RecordBatch.from_arrays(pair, ["a", "b"])

    return (
        distinct_fps.mapInArrow(keys, "c short, k long, fp long")
        .repartition(shuffle_partitions(spark), "c", "k")
        .sortWithinPartitions("c", "k")
        .mapInArrow(links, "a long, b long")
    )


def simhash_components(
    spark: SparkSession, documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``documents`` (doc_id, text);
    component_id is the smallest doc_id reachable.

    Texts are read once and leave as (doc_id, fp). Equal fingerprints collapse by
    a partial aggregate, so a text that a third of all rows copy is one row from there
    on. The join back has the distinct fingerprints on one side; AQE splits its hot ones.

    Defined cases: null and empty texts have fingerprint zero, linked like any other;
    rows with a null doc_id get a component, whose id is null only if none of its rows has
    a doc_id; rows that share a doc_id are separate rows; an empty table gives an empty
    result; other columns are ignored.
    """
    rows = staged(spark, fingerprints(documents, shingle_words), "simhash")
    fps = staged(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    parts = components(spark, fingerprint_links(spark, fps.select("fp"), max_bits))
    rooted = fps.join(parts, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    ids = rooted.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    return rows.join(named, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def keep_first(
    spark: SparkSession, documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """Exactly one document of each component, with all columns: the one with the smallest doc_id (rows without
    one come last, ties go to the smallest text hash).

    The decision is made on narrow rows (doc_id, text hash, fingerprint). Documents that go, and those listed
    several times, are marked in a bit map of fixed size (``critiq.operators.repeats``), broadcast to the scan: a document without a mark stays and is
    not shuffled. Only marked ones meet the exact decision in a join.

    Defined cases: null and empty texts are one component; rows that share a doc_id are told apart by
    their texts' 64-bit hashes, and rows equal in both count as one document listed again, of which one row
    stays; an empty table gives an empty result.
    """
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle_words) for t in text_bytes(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(values.view(np.int64))], ["doc_id", "th", "fp"])

    rows = own.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(each, "doc_id long, th long, fp long")
    rows = staged(spark, rows.groupBy("doc_id", "th", "fp").agg(F.count("*").alias("n")), "simhash-rows")
    fps = rows.select("fp").distinct()
    parts = components(spark, fingerprint_links(spark, fps, max_bits))
    rooted = rows.join(parts, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("component", "fp"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    first = rooted.groupBy(F.col("root").alias("r")).agg(F.min(order).alias("first"))
    decided = rooted.join(first, F.col("root") == F.col("r")).select(
        "doc_id", "th", "n", (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))).alias("stays")
    )
    decided = staged(spark, decided, "simhash-decided")
    key = "xxhash64(coalesce(cast({} as long), -1L), {} is null, {})"
    asked = decided.where("not stays or n > 1").select(F.expr(key.format("doc_id", "doc_id", "th")).alias("h"))
    doc_key = key.format("doc_id", "doc_id", "xxhash64(text)")
    flagged = with_mark(documents, doc_key, marks(asked, "h"))
    sure = flagged.where("not _marked").drop("_marked")
    kept = decided.where("stays").select(F.col("doc_id").alias("_kept_id"), F.col("th").alias("_kept_th"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id")) & (F.xxhash64("text") == F.col("_kept_th"))
    open_ = flagged.where("_marked").drop("_marked").join(kept, same)
    nth = F.row_number().over(Window.partitionBy("_kept_id", "_kept_th").orderBy("_kept_th"))
    open_ = open_.withColumn("_nth_of_row", nth).where("_nth_of_row = 1").drop("_nth_of_row", "_kept_id", "_kept_th")
    return sure.unionByName(open_)
