"""Ranked lexical search: term at a time over short lists, document at a time over long ones.

Documents are dealt into shards of at most SHARD_DOCS. Of each shard the posting lists of the query
terms are kept (document numbers in order and term counts), and the shard's
document lengths. Once the corpus statistics are known, a list's counts become integer impacts, and each item is
run against the shard in two steps:

* term at a time: its short lists (in all at most SHORT_SHARE of the shard's documents) are added up into
  accumulators, one sorted list of documents with their sums, whose largest sum bounds them all together (closer than the
  sum of the lists' own bounds);
* document at a time: that list and the long ones are iterators with bounds. Documents go by in blocks. A block
  whose bounds (per list and block) cannot reach the k-th best score so far is skipped. In another, lists whose bounds together stay
  below that score give no candidates; the others' documents are the candidates, and the
  rest is only looked up, highest bound first, for candidates that can still get there.

The k-th best score of an item goes on from shard to shard of a task, so most blocks of later shards are skipped.
Pruning is by "less than" alone: documents that tie with the k-th are never lost.

The query set is sent to the tasks in blocks of at most BLOCK_ITEMS items and about BLOCK_BYTES of text; every block
runs against all documents. A task returns at most k rows for each item of a block.

Defined cases: null and empty texts have no terms, take no part in a result and do not count; documents that share a
doc_id, or have none, are documents of their own (null comes last among equal scores); of items that share an item_id the
smallest text stands, items without an item_id or without terms have no rows; an empty table gives an empty result;
texts of any length are taken whole; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from critiq.llm.common import shuffle_partitions, sorted_groups, staged, text_bytes

K = 10
#: Documents of a shard, and of a block of it.
SHARD_DOCS, BLOCK_DOCS = 4096, 512
#: Postings after which a shard ends, whatever its documents.
SHARD_POSTINGS = 1 << 20
#: Share of a shard's documents that the lists added up term at a time may have in all.
SHORT_SHARE = 0.125
BLOCK_ITEMS, BLOCK_BYTES = 4096, 1 << 26

POSTINGS = "shard long, term int, docs binary, counts binary, ids array<long>, n_docs long, n_terms long"
RESULT = "item_id long, doc_id long, score long"


def _letters() -> bytes:
    """A byte of a term as it is, A-Z in lower case, any other as a space. All bytes of other code points
    than ASCII's are part of terms."""
    table = bytearray(b" " * 256)
    for c in range(256):
        if chr(c).isalnum() or c >= 0x80:
            table[c] = c + 32 if 65 <= c <= 90 else c
    return bytes(table)


LETTERS = _letters()


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def postings(documents: DataFrame, numbers) -> DataFrame:
    """The shards' lists (``POSTINGS``) of the terms in the broadcast ``numbers`` (term: its number).

    The row of term -1 has the shard's documents that hold any of them (``ids``, their lengths in ``counts``) and the number of all
    documents with terms and of their terms.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema(
            [("shard", pa.int64()), ("term", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()),
             ("ids", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_terms", pa.int64())]
        )
        wanted = numbers.value
        shard = TaskContext.get().partitionId() << 32
        ids, sizes, n_docs, n_terms = [], [], 0, 0
        at: list[int] = []  # term numbers, documents and counts of the postings
        doc: list[int] = []
        tf: list[int] = []

        def done() -> pa.RecordBatch:
            t = np.array(at, np.int32)
            order = np.argsort(t, kind="stable")
            t, d, c = t[order], np.array(doc, "<i4")[order], np.array(tf, "<i8")[order]
            own, first = np.unique(t, return_index=True)
            cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(t)], strict=True)) if len(t) else []
            n = len(own)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard] * (n + 1), pa.int64()),
                    pa.array([-1, *own.tolist()], pa.int32()),
                    pa.array([None, *(d[a:b].tobytes() for a, b in cuts)], pa.binary()),
                    pa.array([np.array(sizes, "<i8").tobytes(), *(c[a:b].tobytes() for a, b in cuts)], pa.binary()),
                    pa.array([ids, *[None] * n], pa.list_(pa.int64())),
                    pa.array([n_docs, *(b - a for a, b in cuts)], pa.int64()),
                    pa.array([n_terms, *[0] * n], pa.int64()),
                ],
                schema=schema,
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                found = terms(text)
                if not found:
                    continue
                n_docs += 1
                n_terms += len(found)
                held = [(wanted[w], n) for w, n in Counter(found).items() if w in wanted]
                if held:
                    doc.extend([len(ids)] * len(held))
                    at.extend(t for t, _ in held)
                    tf.extend(n for _, n in held)
                    ids.append(doc_id)
                    sizes.append(len(found))
                if len(ids) >= SHARD_DOCS or len(at) >= SHARD_POSTINGS:
                    yield done()
                    shard += 1
                    ids, sizes, n_docs, n_terms, at, doc, tf = [], [], 0, 0, [], [], []
        if n_docs:
            yield done()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, POSTINGS)


class Best:
    """The k best (score, doc_id) of an item so far; nulls last among equal scores."""

    __slots__ = ("k", "rows", "least")

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        self.rows += [(-s, i is None, i or 0) for s, i in zip(scores.tolist(), ids, strict=True)]
        self.rows.sort()
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.least = max(1, -self.rows[-1][0])  # what a document must reach


def accumulated(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted documents of several lists, with the sums of their scores."""
    docs = np.concatenate([d for d, _ in lists])
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], np.concatenate([s for _, s in lists])[order]
    first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    return docs[first], np.add.reduceat(scores, first)


class Shard:
    """The lists of one shard, with impacts; what items have in common is worked out once."""

    def __init__(self, rows: pa.RecordBatch, n_all: int, l_all: int):
        term = np.asarray(rows.column(1)).tolist()
        self.ids = rows.column(4)[0].as_py()
        size = np.frombuffer(rows.column(3)[0].as_py(), "<i8")
        norm = 8 * (25 + 75 * size * n_all // l_all)
        self.n, self.n_blocks = len(size), -(-len(size) // BLOCK_DOCS)
        edges = np.arange(self.n_blocks + 1) * BLOCK_DOCS
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.cuts: dict[int, np.ndarray] = {}
        self.bounds: dict[int, np.ndarray] = {}
        for at in range(1, len(term)):
            docs = np.frombuffer(rows.column(2)[at].as_py(), "<i4")
            tf = np.frombuffer(rows.column(3)[at].as_py(), "<i8")
            impact = 1_000_000_000 * tf // (1000 * tf + norm[docs])
            cuts = np.searchsorted(docs, edges)
            bound = np.zeros(self.n_blocks, np.int64)
            some = np.flatnonzero(cuts[1:] > cuts[:-1])
            bound[some] = np.maximum.reduceat(impact, cuts[some])
            t = term[at]
            self.lists[t], self.cuts[t], self.bounds[t] = (docs, impact), cuts, bound

    def search(self, asked: dict[int, int], best: Best) -> None:
        """Add the shard's documents that are among the k best to ``best``; asked: factor of each term."""
        own = [t for t in asked if t in self.lists]
        if not own:
            return
        factor = np.array([asked[t] for t in own])
        bounds = np.array([self.bounds[t] for t in own]) * factor[:, None]  # lists by blocks
        todo = np.flatnonzero(bounds.sum(axis=0) >= best.least)
        if not len(todo):
            return
        by_length = sorted(range(len(own)), key=lambda i: len(self.lists[own[i]][0]))
        total, n_short = 0, 0
        for i in by_length:
            total += len(self.lists[own[i]][0])
            if total > SHORT_SHARE * self.n:
                break
            n_short += 1
        iterators = [(*self.lists[own[i]], self.cuts[own[i]], bounds[i], asked[own[i]]) for i in by_length[n_short:]]
        if n_short:  # term at a time
            docs, sums = accumulated(
                [(self.lists[own[i]][0], self.lists[own[i]][1] * asked[own[i]]) for i in by_length[:n_short]]
            )
            cuts = np.searchsorted(docs, np.arange(self.n_blocks + 1) * BLOCK_DOCS)
            bound = np.zeros(self.n_blocks, np.int64)
            some = np.flatnonzero(cuts[1:] > cuts[:-1])
            bound[some] = np.maximum.reduceat(sums, cuts[some])
            iterators.append((docs, sums, cuts, bound, 1))
        reach = np.sum([it[3] for it in iterators], axis=0)
        for b in todo.tolist():  # document at a time
            if reach[b] >= best.least:
                self._block(b, iterators, best)

    def _block(self, b: int, iterators: list, best: Best) -> None:
        parts = []
        for docs, scores, cuts, bound, factor in iterators:
            if bound[b]:
                parts.append((int(bound[b]), docs[cuts[b] : cuts[b + 1]], scores[cuts[b] : cuts[b + 1]], factor))
        parts.sort(key=lambda p: p[0])
        below, n_rest = 0, 0  # lists that together stay below the score to reach give no candidates
        while n_rest < len(parts) and below + parts[n_rest][0] < best.least:
            below += parts[n_rest][0]
            n_rest += 1
        if n_rest == len(parts):
            return
        sums = np.zeros(BLOCK_DOCS, np.int64)
        seen = np.zeros(BLOCK_DOCS, bool)
        start = b * BLOCK_DOCS
        for _, docs, scores, factor in parts[n_rest:]:
            sums[docs - start] += scores * factor
            seen[docs - start] = True
        alive = np.flatnonzero(seen)
        for bound, docs, scores, factor in parts[:n_rest][::-1]:
            alive = alive[sums[alive] + below >= best.least]
            if not len(alive):
                return
            below -= bound
            at = np.searchsorted(docs, alive + start)
            at[at == len(docs)] = 0
            hit = docs[at] == alive + start
            sums[alive[hit]] += scores[at[hit]] * factor
        alive = alive[sums[alive] >= best.least]
        if len(alive) > best.k:  # those that tie with the k-th stay
            least = np.partition(sums[alive], len(alive) - best.k)[len(alive) - best.k]
            alive = alive[sums[alive] >= least]
        if len(alive):
            best.add(sums[alive], [self.ids[start + i] for i in alive.tolist()])


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """The items and their terms, in blocks that a task can hold."""
    own = (
        items.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .where("item_id is not null and text is not null")
        .groupBy("item_id")
        .agg(F.min("text").alias("text"))
    )
    size = own.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    n_blocks = max(-(-size["n"] // BLOCK_ITEMS), -(-size["b"] // BLOCK_BYTES))
    for block in range(n_blocks):
        rows = own.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block).collect()
        yield [(r["item_id"], Counter(terms(r["text"].encode()))) for r in rows]


def _search_block(spark: SparkSession, documents: DataFrame, block: list[tuple[int, Counter]], k: int) -> DataFrame:
    names = sorted({t for _, asked in block for t in asked})
    numbers = spark.sparkContext.broadcast({t: i for i, t in enumerate(names)})
    lists = staged(spark, postings(documents, numbers), "postings")
    n_all, l_all = lists.where("term = -1").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not n_all:
        return spark.createDataFrame([], RESULT)
    df = {r["term"]: r["df"] for r in lists.where("term >= 0").groupBy("term").agg(F.sum("n_docs").alias("df")).collect()}
    weight = {t: math.floor(1000 * math.log((2 * n_all + 2) / (2 * d + 1))) for t, d in df.items()}
    asked = []
    for item_id, found in block:
        own = {numbers.value[t]: n for t, n in found.items()}
        asked.append((item_id, {t: n * weight[t] for t, n in own.items() if weight.get(t, 0) > 0}))
    queries = spark.sparkContext.broadcast(asked)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries.value]
        for rows in sorted_groups(batches, 1):
            of = np.asarray(rows.column(0))
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b - a > 1:
                    shard = Shard(rows.slice(a, b - a), n_all, l_all)
                    for (_, factors), top in zip(queries.value, best, strict=True):
                        shard.search(factors, top)
        item, doc, score = [], [], []
        for (item_id, _), top in zip(queries.value, best, strict=True):
            item += [item_id] * len(top.rows)
            doc += [None if none else i for _, none, i in top.rows]
            score += [-s for s, _, _ in top.rows]
        columns = [pa.array(c, pa.int64()) for c in (item, doc, score)]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])

    dealt = lists.repartition(shuffle_partitions(spark), "shard").sortWithinPartitions("shard", "term")
    return dealt.mapInArrow(rank, RESULT)


def search(spark: SparkSession, documents: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each item."""
    found = None
    for block in item_blocks(items):
        part = _search_block(spark, documents, block, k)
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
