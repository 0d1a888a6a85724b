"""Exact substring dedup with suffix arrays.

A byte is removed if some string of ``length`` bytes that covers it also starts earlier: in
a document with a smaller doc_id or earlier in the same one. Strings are judged on the input.

1. *Anchors.* Every string has one anchor, the 32-byte piece in it with the smallest hash
   (leftmost of equals), so equal strings have equal anchors at equal places. A run of
   consecutive strings with the same anchor is a snippet: its first start, how many starts, and a hash of its
   bytes. Snippets are dealt out by anchor. One whose bytes occurred earlier is all repeated; that is
   settled among a task's documents before the shuffle and among all after it, as a stream, without
   holding a group. Anchors that occur once are done.
2. *Suffix arrays.* What is left are the first occurrences of different snippets that share an anchor:
   the ends of repeats, and pieces shared by chance. Their bytes are cut from the texts and dealt out by the
   two thirds of a string next to the anchor that all strings on one side of it share. In shards
   of bounded size a suffix array is built by Larsson and Sadakane's refinement: suffixes are sorted
   by eight bytes, then groups still equal, and only those, by the ranks of what follows,
   doubling the depth up to ``length``. Common prefixes with the neighbour in
   the array (Kasai's, all positions at once, up to ``length``) give the strings that
   occur more than once; all but the first start are repeated. A group larger than a
   shard is merged shard by shard: the next one's strings are looked up in the arrays before it by binary search.
   Of one larger than MOST_SHARDS shards, each shard's different strings are dealt out again, by all their bytes, so
   no task holds such a group.
3. *Spans.* The repeated starts of a document are joined to its text.

Defined cases: null and empty texts, and texts under ``length`` bytes, lose nothing; documents without a
doc_id have no place in the order: each is compared with itself alone; rows that share a doc_id and a text are the same document
listed again and lose the same bytes; different texts that share a doc_id are parts of one document, in the order of
their hashes, without strings that cross from one to the next; an empty table gives an empty result; texts of any length are taken whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from critiq.llm.common import shuffle_partitions, sorted_groups, staged, text_bytes

LENGTH = 100
ANCHOR = 32
#: Bytes of text whose anchors a task settles at a time, and of snippets in one suffix array.
CHUNK_BYTES, SHARD_BYTES = 1 << 24, 1 << 20
#: Shards of one group that are merged in its task.
MOST_SHARDS = 8
#: A start holds the number of the text among those that share its doc_id above so many bits.
PART_BITS = 40
#: Bits of the map that says which documents' texts are wanted.
MAP_BITS = 24

_MIX = 0xD6E8FEB86659FD93
_BASE = 0x9E3779B97F4A7C15


def anchor_hashes(data: np.ndarray, width: int = ANCHOR) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes (a power of two) from each position on."""
    table = np.random.default_rng(3).integers(0, 2**63, 256, np.uint64)
    h, n, base = table[data], 1, _BASE
    while n < width:
        h = h[:-n] * np.uint64(base) + h[n:]
        base, n = base * base & (2**64 - 1), 2 * n
    h ^= h >> np.uint64(29)
    h *= np.uint64(_MIX)
    return h ^ (h >> np.uint64(32))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[:-n], values[n:])
        n *= 2
    return np.minimum(values[: len(values) - (width - n)], values[width - n :]) if width > n else values


def snippets(text: bytes, length: int = LENGTH, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first start, starts) of the runs of strings with the same anchor."""
    width, ends = length - ANCHOR + 1, len(text) - length + 1
    hashes, firsts, last = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], -1
    for at in range(0, ends, block):
        h = anchor_hashes(np.frombuffer(text, np.uint8, min(block + length - 1, len(text) - at), at))
        # the hash's upper bits, then the position, so the leftmost of equals is least
        packed = (h & np.uint64(2**64 - 2**24)) | np.arange(len(h), dtype=np.uint64)
        chosen = (sliding_least(packed, width) & np.uint64(2**24 - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[chosen[0] + at != last, chosen[1:] != chosen[:-1]])
        hashes.append(h[chosen[first]])
        firsts.append(first + at)
        last = chosen[-1] + at
    first = np.concatenate(firsts)
    return np.concatenate(hashes), first, np.diff(np.r_[first, max(ends, 0)])


def merged(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of starts, sorted and with those that touch put together."""
    order = np.lexsort((start, doc))
    doc, whole, n = doc[order], start[order], n[order]
    if not len(doc):
        return doc, whole, n
    start = whole & ((1 << PART_BITS) - 1)
    other = (doc[1:] != doc[:-1]) | (whole[1:] >> PART_BITS != whole[:-1] >> PART_BITS)
    group = np.r_[0, np.cumsum(other)]
    span = int((start + n).max()) + 1
    end = np.maximum.accumulate(start + n + group * span) - group * span
    new = np.r_[True, other | (start[1:] > end[:-1])]
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(doc)] - 1
    return doc[at], whole[at], end[last] - start[at]


#: kind 0: a snippet to compare; kind 1: starts found repeated.
SNIPPETS = "kind short, h long, n long, same long, doc long, start long"


def _snippet_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Snippets of a task's documents; of those with the same bytes only the first is kind 0."""
    import xxhash

    def settled(held: list[tuple]) -> pa.RecordBatch:
        h, n, same, doc, start = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((start, doc, same, n, h))
        h, n, same, doc, start = (x[order] for x in (h, n, same, doc, start))
        new = np.r_[True, (h[1:] != h[:-1]) | (n[1:] != n[:-1]) | (same[1:] != same[:-1])]
        head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        again = ~new & ((doc != doc[head]) | (start != start[head]))
        d, s, m = merged(doc[again], start[again], n[again])
        keep = np.flatnonzero(new)
        zero = np.zeros(len(d), np.int64)
        kind = np.r_[np.zeros(len(keep), np.int16), np.ones(len(d), np.int16)]
        # repeated starts are spread over the partitions by their place
        place = ((d * 31 + s).view(np.uint64) * np.uint64(_MIX)).view(np.int64)
        columns = [
            kind, np.r_[h[keep].view(np.int64), place], np.r_[n[keep], m], np.r_[same[keep].view(np.int64), zero],
            np.r_[doc[keep], d], np.r_[start[keep], s],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in SNIPPETS.split(", ")])

    held, size = [], 0
    for batch in batches:
        for doc, part, text in zip(*(c.to_pylist() for c in batch.columns[:2]), text_bytes(batch.column(2)), strict=True):
            h, start, n = snippets(text or b"", length)
            if not len(h):
                continue
            digest, ends = xxhash.xxh3_64_intdigest, (start + n + length - 1).tolist()
            same = np.array([digest(text[a:b]) for a, b in zip(start.tolist(), ends, strict=True)], np.uint64)
            held.append((h, n, same, np.full(len(h), doc), start + (part << PART_BITS)))
            size += len(text)
            if size >= CHUNK_BYTES:
                yield settled(held)
                held, size = [], 0
    if held:
        yield settled(held)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From snippets sorted by all but their kind: kind 1, starts found repeated; kind 0, first occurrences of
    snippets whose anchor has other snippets too. Carries one row from batch to batch."""
    names = [f.split()[0] for f in SNIPPETS.split(", ")]
    head = None  # (h, n, same, doc, start) of the first row of the current snippet
    alone = False  # whether it is the first of its anchor, and so not yet passed on
    for batch in batches:
        kind, h, n, same, doc, start = (np.asarray(c) for c in batch.columns)
        done = np.flatnonzero(kind == 1)
        rows = np.flatnonzero(kind == 0)
        out = [tuple(x[done] for x in (kind, h, n, same, doc, start))]
        if len(rows):
            h, n, same, doc, start = (x[rows] for x in (h, n, same, doc, start))
            if head is not None:
                h, n, same, doc, start = (np.r_[np.array([a], x.dtype), x] for a, x in zip(head, (h, n, same, doc, start), strict=True))
            new_h = np.r_[True, h[1:] != h[:-1]]
            new = new_h | np.r_[True, (n[1:] != n[:-1]) | (same[1:] != same[:-1])]
            at = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            again = ~new & ((doc != doc[at]) | (start != start[at]))
            out.append((np.ones(again.sum(), np.int16), h[again], n[again], same[again], doc[again], start[again]))
            # the snippets, one row each, and whether their anchor has an earlier or a later one
            one = np.flatnonzero(new)
            begins = new_h[one]
            shared = ~begins | np.r_[~begins[1:], False]
            sent = shared.copy()
            if head is not None:
                begins[0] = alone  # the carried snippet
                shared[0] = not alone or (len(one) > 1 and not new_h[one[1]])
                sent[0] = shared[0] and alone
            pick = one[sent]
            out.append((np.zeros(len(pick), np.int16), h[pick], n[pick], same[pick], doc[pick], start[pick]))
            last = one[-1]
            head = (h[last], n[last], same[last], doc[last], start[last])
            alone = not bool(shared[-1])
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of the ``depth`` bytes from them on. Larsson and Sadakane: only groups
    still equal are sorted again, by the ranks of what follows the part that is."""
    n = len(data)
    padded = np.r_[data, np.zeros(8, np.uint8)].astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    ranks, reach = np.empty(n + 1, np.int64), 8
    ranks[n] = -1  # past the end
    ordered = key[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    ranks[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while reach < depth:
        step = min(reach, depth - reach)
        slots = np.flatnonzero(~(first & np.r_[first[1:], True]))
        if not len(slots):
            break
        at = order[slots]
        both = (ranks[at] << 32) | (ranks[np.minimum(at + step, n)] + 1)
        again = np.argsort(both, kind="stable")
        at, both = at[again], both[again]
        order[slots] = at
        begins = np.r_[True, both[1:] != both[:-1]]
        first[slots] = begins
        ranks[at] = slots[np.maximum.accumulate(np.where(begins, np.arange(len(slots)), 0))]
        reach += step
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes, up to ``most`` where more, that each suffix shares with the one before it in the array.

    Kasai's observation: if the suffix at p shares m bytes with its neighbour at q, the one at p + 1 shares m - 1
    with q + 1. Only positions whose neighbour is not the next of the last one's are compared byte by
    byte; the others follow from them.
    """
    n = len(data)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    head = np.flatnonzero(np.r_[True, before[1:] != before[:-1] + 1] | (before < 0))
    end, out = np.r_[head[1:], n], np.zeros(n, np.int64)
    while len(head):
        shared, alive, k = np.zeros(len(head), np.int64), np.flatnonzero(before[head] >= 0), 0
        while len(alive):
            p, q = head[alive] + k, before[head[alive]] + k
            go = (np.maximum(p, q) < n) & (k < most + end[alive] - head[alive])
            alive, p, q = alive[go], p[go], q[go]
            alive = alive[data[p] == data[q]]
            shared[alive] += 1
            k += 1
        some = np.minimum(shared, end - head)
        inside = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        out[np.repeat(head, some) + inside] = np.repeat(shared, some) - inside
        head = head + shared + 1  # past the byte that differs nothing follows from it
        head, end = head[head < end], end[head < end]
    return out[order]


class Shard:
    """The suffix array of some snippets, reduced to the strings at their starts, and the first place of each string."""

    def __init__(self, rows: list[tuple[int, int, int, bytes]], length: int):
        self.length = length
        self.data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        n = np.array([r[2] for r in rows])
        begins = np.cumsum([0, *(len(r[3]) for r in rows)])[:-1]
        which = np.repeat(np.arange(len(rows)), n)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        at = begins[which] + inside
        doc = np.array([r[0] for r in rows])[which]
        start = np.array([r[1] for r in rows])[which] + inside
        order = suffix_array(self.data, length)
        # strings at starts only, in the array's order, and what each shares with the one before
        is_start = np.full(len(self.data), -1)
        is_start[at] = np.arange(len(at))
        slots = np.flatnonzero(is_start[order] >= 0)
        kept = order[slots]
        own = is_start[kept]
        prefixes = common_prefixes(self.data, order, length)[: slots[-1] + 1]
        shared = np.minimum.reduceat(prefixes, np.r_[0, slots[:-1] + 1])
        new = np.r_[True, shared[1:] < length]
        group = np.cumsum(new) - 1
        doc, start = doc[own], start[own]
        by = np.lexsort((start, doc, group))
        first = np.r_[True, group[by][1:] != group[by][:-1]]
        firsts = by[first]
        again = (doc != doc[firsts][group]) | (start != start[firsts][group])
        self.repeated = doc[again], start[again]
        self.at, self.doc, self.start = kept[firsts], doc[firsts], start[firsts]  # in the order of the strings

    def strings(self, at: np.ndarray) -> np.ndarray:
        return np.lib.stride_tricks.sliding_window_view(self.data, self.length)[at]

    def find(self, other: Shard) -> np.ndarray:
        """Which of the other shard's strings are in this one: binary search in the array."""
        wanted = other.strings(other.at)
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(self.at))
        for _ in range(max(1, int(len(self.at)).bit_length())):
            open_ = np.flatnonzero(low < high)
            middle = (low[open_] + high[open_]) // 2
            less = _before(self.strings(self.at[middle]), wanted[open_])
            low[open_[less]], high[open_[~less]] = middle[less] + 1, middle[~less]
        found = low < len(self.at)
        found[found] = (self.strings(self.at[low[found]]) == wanted[found]).all(axis=1)
        return found


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of bytes of a sorts before that of b."""
    differ = a != b
    at = differ.argmax(axis=1)
    rows = np.arange(len(a))
    return a[rows, at] < b[rows, at]


def _repeated_in_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(doc, start, n) of repeated starts, from snippets sorted by (key, doc, start); of groups of more than
    MOST_SHARDS shards also (doc, start, 1, string) of what is still to be compared."""
    names = ["doc", "start", "n", "string"]

    def rows_out(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        doc = np.concatenate([np.empty(0, np.int64), *(f[0] for f in found)])
        start = np.concatenate([np.empty(0, np.int64), *(f[1] for f in found)])
        ranges = merged(doc, start, np.ones(len(doc), np.int64))
        none = pa.nulls(len(ranges[0]), pa.binary())
        return pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in ranges), none], names)

    def strings_out(shard: Shard) -> pa.RecordBatch:
        strings = pa.array([row.tobytes() for row in shard.strings(shard.at)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(shard.doc), pa.array(shard.start), pa.array(np.ones(len(shard.at), np.int64)), strings], names)

    def last_of_group() -> Iterator[pa.RecordBatch]:
        if not flooded:
            yield rows_out(_shard_repeats(held, earlier, length))
        elif held:
            shard = Shard(held, length)
            yield rows_out([shard.repeated])
            yield strings_out(shard)

    held: list[tuple[int, int, int, bytes]] = []  # rows of the next shard
    size, earlier, whole_from, last, flooded = 0, [], 0, None, False
    # earlier: the shards of a group that goes on; whole_from: where in held the last group begins
    for batch in batches:
        keys = batch.column(0).to_pylist()
        columns = [c.to_pylist() for c in batch.columns[1:]]
        for key, doc, start, n, piece in zip(keys, *columns, strict=True):
            if key != last:
                if size >= SHARD_BYTES or earlier or flooded:  # the group that ends goes with what is held
                    yield from last_of_group()
                    held, size, earlier, flooded = [], 0, [], False
                last, whole_from = key, len(held)
            held.append((doc, start, n, piece))
            size += len(piece)
            if size >= 2 * SHARD_BYTES:  # a group larger than a shard: what is whole goes first
                if whole_from and not earlier and not flooded:
                    yield rows_out(_shard_repeats(held[:whole_from], [], length))
                    held, whole_from = held[whole_from:], 0
                    size = sum(len(r[3]) for r in held)
                if size >= SHARD_BYTES:
                    shard = Shard(held, length)
                    yield rows_out([shard.repeated, *_looked_up(shard, earlier)])
                    earlier.append(shard)
                    held, size = [], 0
                    if flooded or len(earlier) > MOST_SHARDS:
                        flooded = True
                        for done in earlier:
                            yield strings_out(done)
                        earlier = []
    if held:
        yield from last_of_group()


def _shard_repeats(rows: list[tuple], earlier: list[Shard], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    if not rows:
        return []
    shard = Shard(rows, length)
    return [shard.repeated, *_looked_up(shard, earlier)]


def _looked_up(shard: Shard, earlier: list[Shard]) -> list[tuple[np.ndarray, np.ndarray]]:
    """First places in ``shard`` of strings that shards of earlier documents have."""
    out = []
    for before in earlier:
        found = before.find(shard)
        out.append((shard.doc[found], shard.start[found]))
    return out


def _only_marked(spark: SparkSession, rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` (doc, ...) but for most whose doc is not among ``ids`` (one column). A map of fixed
    size says which may be; what it lets through by accident falls out in the join that follows."""
    place = F.shiftrightunsigned(F.xxhash64("doc"), 64 - MAP_BITS)
    found = ids.toDF("doc").select(
        F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(doc), {64 - MAP_BITS}) & 63 as int))").alias("bit")
    )
    table = found.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2**(MAP_BITS - 6) rows
    marked = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    marked[np.asarray(table["word"])] = np.asarray(table["bits"]).view(np.uint64)
    shared, names = spark.sparkContext.broadcast(marked), rows.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.asarray(batch.column(len(names)))
            bits = shared.value[place >> 6] >> (place & 63).astype(np.uint64)
            yield batch.select(names).filter(pa.array((bits & np.uint64(1)).astype(bool)))

    return rows.withColumn("_place", place).mapInArrow(keep, rows.schema)


def numbered(documents: DataFrame) -> DataFrame:
    """``doc, part, text`` of every row: part numbers the different texts of a doc_id (0 if there is one).

    Which ids have several is found with narrow rows; mostly none have, and texts are not shuffled.
    """
    own = documents.select(F.col("doc_id").cast("long").alias("doc"), "text")
    hashes = own.where("doc is not null and text is not null").select("doc", F.xxhash64("text").alias("th"))
    several = hashes.groupBy("doc").agg(F.min("th").alias("low"), F.max("th").alias("high")).where("low != high")
    if several.isEmpty():
        return own.select("doc", F.lit(0).cast("long").alias("part"), "text")
    parts = hashes.join(several.select("doc"), "doc", "left_semi").distinct()
    nth = (F.row_number().over(Window.partitionBy("doc").orderBy("th")) - 1).cast("long")
    parts = parts.select(F.col("doc").alias("in_doc"), F.col("th").alias("of_text"), nth.alias("nth"))
    joined = own.join(parts, (F.col("doc") == F.col("in_doc")) & (F.xxhash64("text") == F.col("of_text")), "left")
    return joined.select("doc", F.coalesce("nth", F.lit(0)).alias("part"), "text")


def repeated_starts(spark: SparkSession, rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc, start, n``: runs of n consecutive starts of strings that also start earlier, in rows (doc, part, text)."""
    own = rows.where("doc is not null")
    n_parts, order = shuffle_partitions(spark), ["h", "n", "same", "doc", "start"]
    compared = staged(
        spark,
        own.mapInArrow(lambda batches: _snippet_rows(batches, length), SNIPPETS)
        .repartition(n_parts, "h")
        .sortWithinPartitions(*order)
        .mapInArrow(_compared, SNIPPETS),
        "snippets",
    )
    asked = compared.where("kind = 0").select(F.col("doc").alias("in_doc"), "start", "n")
    texts = _only_marked(spark, own, asked.select("in_doc").distinct())
    wanted = asked.groupBy("in_doc").agg(F.collect_set(F.struct("start", "n")).alias("wanted"))  # at most the document's snippets
    side = ANCHOR + (length - ANCHOR) // 2  # bytes that strings on one side of the anchor share

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            rows = []
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), batch.column(3).to_pylist()
            for doc, part, text, places in zip(*columns, strict=True):
                base = part << PART_BITS
                places = [{"start": p["start"] - base, "n": p["n"]} for p in places if p["start"] >> PART_BITS == part] if text else []
                anchors = _anchor_places(text, places, length)
                for place, anchor in zip(places, anchors, strict=True):
                    a, b = place["start"], place["start"] + place["n"]
                    # strings from middle on hold the bytes after the anchor, those before it the bytes before
                    middle = min(max(a, anchor - (length - side)), b)
                    for s, e, near in ((middle, b, text[anchor : anchor + side]), (a, middle, text[anchor + ANCHOR - side : anchor + ANCHOR])):
                        if s < e:
                            rows.append((xxhash.xxh64_intdigest(near, 1) >> 1, doc, s + base, e - s, text[s : e - 1 + length]))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "doc", "start", "n", "piece"])

    pieces = (
        texts.join(wanted, F.col("doc") == F.col("in_doc"))
        .select("doc", "part", "text", "wanted")
        .where(F.octet_length("text") >= length)  # shorter rows of the same doc_id have no strings
        .mapInArrow(cut, "key long, doc long, start long, n long, piece binary")
        .repartition(n_parts, "key")
        .sortWithinPartitions("key", "doc", "start")
    )
    found = pieces.mapInArrow(lambda batches: _repeated_in_groups(batches, length), "doc long, start long, n long, string binary")
    found = staged(spark, found, "in-groups")
    # a shard passes a string on once, so a string has at most as many rows as its group has shards
    first = F.min(F.struct("doc", "start")).over(Window.partitionBy("string"))
    again = found.where("string is not null").withColumn("first", first).where("doc != first.doc or start != first.start")
    partly = found.where("string is null").select("doc", "start", "n").union(again.select("doc", "start", "n"))
    return compared.where("kind = 1").select("doc", "start", "n").union(partly)


def _anchor_places(text: bytes, places: list[dict], length: int) -> list[int]:
    """Where the anchor of each snippet is: the smallest hash, leftmost, of its first string."""
    out = []
    for p in places:
        first = np.frombuffer(text[p["start"] : p["start"] + length], np.uint8)
        out.append(p["start"] + int(np.argmin(anchor_hashes(first) >> np.uint64(24))))
    return out


def dedup_substrings(spark: SparkSession, documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) of every row of ``documents``."""
    own = numbered(documents)
    starts = staged(spark, repeated_starts(spark, own, length), "repeated").withColumnRenamed("doc", "in_doc")
    starts = starts.groupBy("in_doc").agg(F.collect_list(F.struct("start", "n")).alias("starts"))  # at most the document's strings
    joined = own.join(starts, F.col("doc") == F.col("in_doc"), "left").select("doc", "text", "starts", "part")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids, runs, parts = batch.column(0), batch.column(2), batch.column(3).to_pylist()
            for i, text in enumerate(text_bytes(batch.column(1))):
                text, own = text or b"", runs[i].values if runs[i].is_valid else None
                if not ids[i].is_valid and len(text) > length:  # compared with itself alone
                    a = Shard([(0, 0, len(text) - length + 1, text)], length).repeated[1]
                    n = np.ones(len(a), np.int64)
                elif own is None or not len(own):
                    rows.append((len(text), 0, 0, text))
                    continue
                else:
                    a, n = np.asarray(own.field("start")), np.asarray(own.field("n"))
                    mine = a >> PART_BITS == parts[i]
                    a, n = a[mine] - (parts[i] << PART_BITS), n[mine]
                edge = np.zeros(len(text) + 1, np.int64)
                inside = a < len(text)
                np.add.at(edge, a[inside], 1)
                np.add.at(edge, np.minimum(a + n - 1 + length, len(text))[inside], -1)
                gone = np.cumsum(edge)[:-1] > 0
                spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
                rows.append((len(text), int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()))
            n, removed, spans, kept = zip(*rows, strict=True) if rows else ((), (), (), ())
            numbers = [pa.array(c, pa.int64()) for c in (n, removed, spans)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(each, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
