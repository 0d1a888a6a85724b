"""Scoring of texts by a causal self-attention model over subword ids, trained in numpy.

Text is lower-cased (A-Z), cut into words, and each word into the ids of a public tokenizer; a document ends with an end symbol.

The model is one layer of masked self-attention with a feed-forward part (``Attention``). Its input are words, as the sum of the vectors
of their first and last id (frequent ids have a vector of their own), its output is a distribution over classes of first ids: the most frequent are
classes of their own, the rest is cut into classes of equal count, ids of like company (TOPICS) together. A word w with ids p1, ..., pk after a context has probability

    P(class of p1 | context) * known * c(w) / C(class of p1)                      if the training texts have it, else
    P(class of p1 | context) * (1 - known) * u(p1) * product over later pieces of (more * v(p | class before)) * (1 - more)

c(w) is the word's count in the training texts, C the count of words that begin with a class, u(p) an id's share of its
class among first pieces, v(p) its share of the pieces after one of a class, more the share of pieces that another one follows, and 1 - known the share of tokens that are the only one
of their word (Good-Turing: what a new token is unknown by). So the model says what kind of word follows, the counts which; unknown words are
spelled. Counts, classes, shares and the network's weights all come from all training texts.

On Spark:

1. Documents are dealt into chunks of at most CHUNK_WORDS words (a longer document is a chunk). A chunk's rows: its documents
   as codes of its own word list, and that list with training counts (dealt into buckets by a hash of the word, one row each).
2. Word lists are summed in their buckets, where each distinct word is tokenized, once, and counts and ids of its words go back to each
   chunk; no vocabulary is broadcast or gathered. Counts of ids and classes have the tokenizer's size. With them a chunk writes groups of at most
   GROUP_WINDOWS training windows, which together hold every training word once as what is to be said.
3. Training: one of ROUNDS parts of every group is a round's. In each round every group goes on from the
   same weights with its own windows (Adam), and the new weights are averaged by window counts, added up as integers, so
   that their order does not matter. Windows are never shuffled. Only the average, of fixed size, comes to the driver.
4. A chunk is scored with what came back: windows of WINDOW words that overlap by OVERLAP, each token scored once, in the first window
   that has it, with windows of like length in a batch.

Defined cases: null and empty texts are the end symbol alone; documents that share a doc_id or have none are scored each on its
own (without one: the hash of the empty text); a word that the tokenizer drops counts as one unknown id; without training texts counts are zero
and all classes are alike but for the weights' start; an empty table gives an empty result; texts of any length are taken whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.llm import common
from critiq.llm.common import one_blas_thread, per_worker, pieces, shuffle_partitions, sorted_groups, staged, text_bytes
from critiq.llm.packing import CACHED_BYTES, MARKS, word_encoder

#: A document is held out if crc32 of its id as text is divisible by this.
HELD_OUT = 10
#: Ids of the tokenizer that no text has: the start of a document and its end.
START_ID, END_ID = 49406, 49407
N_IDS = 49408
CHUNK_WORDS = 1 << 21
WINDOW, OVERLAP = 64, 8
GROUP_WINDOWS, ROUNDS, BATCH, MIN_STEPS = 1 << 14, 4, 32, 96
DIM, HEAD_CLASSES, CLASSES = 16, 32, 64
#: Groups of ids by the company they keep, and the ids whose company counts.
TOPICS, MARKERS = 8, 48
#: Ids with a vector of their own; the others have that of their class.
OWN_ROWS = 2048
RATE = 0.01
#: Weight, in pieces, of the shares without regard to the piece before.
SMOOTH = 20.0
#: Windows scored together.
SCORE_BATCH = 64
#: Weights are added up in units of 2**-SCALE, and leave tasks in blocks.
SCALE, BLOCK = 20, 4096
SEED = 11

#: No id: after a window's end, and for the last id of a word that has one.
PAD = 0xFFFF
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Runs of letters whose ids a worker keeps.
KNOWN_PARTS = 300_000
#: Buckets of words for each shuffle partition.
BUCKETS = 8
ROWS = "kind int, chunk long, bucket int, doc_id long, held_out boolean, size long, body binary, numbers binary, n long"
REPLIES = "kind int, chunk long, n long, begin long, size long, body binary, pairs binary"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LOWER).split()


def words_in(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray]:
    """The ``words_of`` texts, end to end, and how many each has."""
    return common.words_in(texts, LOWER)


class _Numbers(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def word_ids(path: str):
    """(ids of a list of words, end to end, and how many each has)."""
    import os
    from array import array

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    encoded = word_encoder(path, cached_words=50_000)
    model, letters, plain = encoded.model, encoded.letters, encoded.plain
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    none = np.array([START_ID], "<u2").tobytes()
    # the ids of runs of letters (two generations), and of punctuation: words share them, and so do chunks
    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}
    marked: dict[str, bytes] = {"": b""}

    def direct(part: str) -> bytes:
        written = part if part.isascii() else part.encode().decode("latin-1").translate(letters)
        return array("H", [t.id for t in model.tokenize(written)]).tobytes()

    def of_run(run: str) -> bytes:
        found = older.get(run)
        known[run] = found = direct(run) if found is None else found
        return found

    def of_marks(marks: str) -> bytes:
        marked[marks] = found = direct(marks)
        return found

    def ids(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        nonlocal known, older, marked
        if len(known) > KNOWN_PARTS:
            known, older = {}, known
        if len(marked) > KNOWN_PARTS:
            marked = {"": b""}
        each, others = [none] * len(words), range(len(words))
        if plain is not None and words:
            others = []
            for i, word in enumerate(b"\n".join(words).decode("utf-8", "replace").split("\n")):
                run = word.rstrip(MARKS)
                found = known.get(run)  # only what has matched before is there
                if found is None or len(words[i]) > CACHED_BYTES:
                    if len(words[i]) > CACHED_BYTES or plain.fullmatch(word) is None:
                        others.append(i)
                        continue
                    run_lower = run.lower()
                    found = known.get(run_lower)
                    if found is None:
                        found = of_run(run_lower)
                if len(run) < len(word):
                    marks = word[len(run) :]
                    more = marked.get(marks)
                    found += of_marks(marks) if more is None else more
                each[i] = found or none
        for i, found in zip(others, encoded.each([words[i] for i in others]), strict=True):
            each[i] = np.frombuffer(found, "<u4").astype("<u2").tobytes() or none
        many = np.array([len(x) >> 1 for x in each], np.int64)
        flat = np.frombuffer(b"".join(each), "<u2")
        special = np.unique(np.repeat(np.arange(len(each)), many)[flat >= START_ID]).tolist()
        if special:
            for i in special:
                found = tokenizer.encode(words[i].decode("utf-8", "replace"), add_special_tokens=False).ids if each[i] is not none else []
                each[i] = np.array(found, "<u2").tobytes() or none
            many = np.array([len(x) >> 1 for x in each], np.int64)
            flat = np.frombuffer(b"".join(each), "<u2")
        return flat, many

    return ids


def windows_of(codes: list[np.ndarray], heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """All words of documents (arrays of codes; ``heads`` and ``tails``: first and last ids of each code) and their end symbols in windows (n, 2, WINDOW + 1) of heads and
    tails, padded. A window's first place is context only: the word before it, or the start symbol."""
    size = np.array([len(c) + 2 for c in codes], np.int64)  # with start and end
    every = np.concatenate([x for c in codes for x in ((len(heads),), c, (len(heads) + 1,))]).astype(np.int64)
    both = np.stack([np.r_[heads, START_ID, END_ID][every], np.r_[tails, PAD, PAD][every]]).astype("<u2")
    n = -(-(size - 1) // WINDOW)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    ends = np.cumsum(size)
    at = np.repeat(ends - size, n)[:, None] + nth[:, None] * WINDOW + np.arange(WINDOW + 1)
    inside = at < np.repeat(ends, n)[:, None]
    return np.where(inside, both[:, np.minimum(at, len(every) - 1)], np.uint16(PAD)).transpose(1, 0, 2)


def coded(documents: DataFrame, n_buckets: int) -> DataFrame:
    """``ROWS``: documents (kind 0: their places in the chunk, n, and codes of words, compressed) and words by bucket (1: the words, compressed, their
    codes and training counts) of all chunks."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        codec = pa.Codec("zstd", 1)
        schema = pa.schema(
            [("kind", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
             ("size", pa.int64()), ("body", pa.binary()), ("numbers", pa.binary()), ("n", pa.int64())]
        )
        chunk = TaskContext.get().partitionId() << 32
        docs, total = [], 0  # (doc_id, held out, words)
        parts: list[pa.Array] = []  # their words

        def table(kind: int, rows: int, **columns) -> pa.RecordBatch:
            given = {"kind": pa.array(np.full(rows, kind, np.int32)), "chunk": pa.array(np.full(rows, chunk, np.int64))} | columns
            return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

        def done() -> Iterator[pa.RecordBatch]:
            coded = pa.concat_arrays(parts).dictionary_encode()  # words are numbered as they first come
            names, flat = coded.dictionary.to_pylist(), np.asarray(coded.indices).astype("<u4")
            cuts = np.cumsum([n for _, _, n in docs])
            codes = [flat[b - n : b] for (_, _, n), b in zip(docs, cuts.tolist(), strict=True)]
            bodies = [codec.compress(c, asbytes=True) if len(c) else b"" for c in codes]
            train = [c for (_, held, _), c in zip(docs, codes, strict=True) if not held]
            n_train = np.bincount(np.concatenate([*train, flat[:0]]), minlength=len(names))
            for a in range(0, len(docs), 1000):
                part = docs[a : a + 1000]
                yield table(
                    0,
                    len(part),
                    doc_id=pa.array([d for d, _, _ in part], pa.int64()),
                    held_out=pa.array([h for _, h, _ in part]),
                    size=pa.array([n for _, _, n in part], pa.int64()),
                    body=pa.array(bodies[a : a + 1000], pa.binary()),
                    n=pa.array(np.arange(a, a + len(part))),
                )
            bucket = np.array([zlib.crc32(w) % n_buckets for w in names], np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            some = np.flatnonzero(cuts[1:] > cuts[:-1])
            lists, pairs, sizes = [], [], []
            for k in some.tolist():
                own = order[cuts[k] : cuts[k + 1]]
                words = b"\n".join([names[i] for i in own.tolist()])
                lists.append(codec.compress(words, asbytes=True))
                sizes.append(len(words))
                pairs.append(np.array([own, n_train[own]], "<u4").tobytes())
            yield table(
                1, len(some), bucket=pa.array(some, pa.int32()), size=pa.array(sizes, pa.int64()),
                body=pa.array(lists, pa.binary()), numbers=pa.array(pairs, pa.binary()),
            )

        for batch in pieces(batches):
            words, many = words_in(list(text_bytes(batch.column(1))))
            begin = end = 0
            for doc_id, n in zip(batch.column(0).to_pylist(), many.tolist(), strict=True):
                own = zlib.crc32(b"%d" % doc_id if doc_id is not None else b"")
                docs.append((doc_id, own % HELD_OUT == 0, n))
                end += n
                total += n + 1
                if total >= CHUNK_WORDS:
                    parts.append(words[begin:end])
                    yield from done()
                    chunk += 1
                    docs, total, parts, begin = [], 0, [], end
            parts.append(words[begin:end])
        if docs:
            yield from done()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, ROWS)


def training_windows(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """``n, windows``: groups of training windows (how many, compressed) of all chunks, from their documents (of, held_out, size, body, n) and what
    ``_counted`` gives back (chunk, n, size, body). The words' ids are there, so no word is tokenized again."""

    def each(docs: pa.Table, lists: pa.Table) -> pa.Table:
        codec = pa.Codec("zstd", 1)
        docs = docs.sort_by("n")  # as they stand in the chunk
        train = [
            np.frombuffer(codec.decompress(x, 4 * s, asbytes=True), "<u4") if s else np.empty(0, "<u4")
            for x, s, held in zip(*(docs[c].to_pylist() for c in ("body", "size", "held_out")), strict=True)
            if not held
        ]
        rows, bodies = [], []
        if train:
            _, many, flat = _word_list(lists, codec)
            last = np.cumsum(many) - 1
            windows = windows_of(train, flat[last - many + 1], np.where(many > 1, flat[last], np.uint16(PAD)))
            order = np.random.default_rng(SEED).permutation(len(windows))
            for own in np.array_split(order, -(-len(order) // GROUP_WINDOWS)):
                rows.append(len(own))
                bodies.append(codec.compress(np.ascontiguousarray(windows[own]), asbytes=True))
        return pa.table({"n": pa.array(rows, pa.int64()), "windows": pa.array(bodies, pa.binary())})

    return docs.groupBy("of").cogroup(lists.groupBy("chunk")).applyInArrow(each, "n long, windows binary")


def chunks(documents: DataFrame, tokenizer: str, n_buckets: int) -> DataFrame:
    """All rows of chunks: those of ``coded``, those of ``_counted``, and training windows (kind 2: n, windows), each kind from a table that is written once."""
    spark, n_parts = documents.sparkSession, shuffle_partitions(documents.sparkSession)
    table = staged(spark, coded(documents, n_buckets), "lm-chunks")
    lists = table.where("kind = 1").select("bucket", "chunk", "size", "body", "numbers")
    lists = lists.repartition(n_parts, "bucket").sortWithinPartitions("bucket")
    replies = staged(spark, lists.mapInArrow(lambda batches: _counted(batches, tokenizer), REPLIES), "lm-words")
    docs = table.where("kind = 0").select(F.col("chunk").alias("of"), "held_out", "size", "body", "n")
    lists = replies.where("kind = 3").select("chunk", "n", "size", "body")
    windows = staged(spark, training_windows(docs, lists), "lm-windows").withColumn("kind", F.lit(2))
    return table.unionByName(replies, allowMissingColumns=True).unionByName(windows, allowMissingColumns=True)


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The groups of windows (n, 2, WINDOW + 1) in rows (n, windows)."""
    codec = pa.Codec("zstd")
    for batch in batches:
        for n, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = codec.decompress(body.as_buffer(), n * 4 * (WINDOW + 1), asbytes=True)
            yield np.frombuffer(raw, "<u2").reshape(n, 2, WINDOW + 1)


@dataclass(frozen=True)
class Classes:
    of: np.ndarray  # class of each id
    first: np.ndarray  # log of an id's share of its class among ids that begin words
    later: np.ndarray  # log of its share of all other ids
    row: np.ndarray  # input row of each id; PAD: of none
    prior: np.ndarray  # log share of each class
    begin: np.ndarray  # words that begin with each class
    more: float  # log share of pieces that another one of their word follows
    no_more: float  # and of those that end it

    def arrays(self) -> tuple:
        """What a broadcast carries: tasks need not be able to import this module."""
        return self.of, self.first, self.later, self.row, self.prior, self.begin, self.more, self.no_more

    @staticmethod
    def fit(counts: np.ndarray, starts: np.ndarray, topic: np.ndarray) -> Classes:
        """From the counts of ids, and of ids that begin words (the end symbol among both), and the ids' topics."""
        weight = starts + 0.5
        order = by_count(starts)
        rank = np.empty(N_IDS, np.int64)
        rank[by_count(counts)] = np.arange(N_IDS)
        order = np.r_[order[:HEAD_CLASSES], order[HEAD_CLASSES:][np.argsort(topic[order[HEAD_CLASSES:]], kind="stable")]]
        rest = weight[order[HEAD_CLASSES:]]
        n_bins = CLASSES - HEAD_CLASSES
        bins = np.minimum((np.cumsum(rest) - rest / 2) / rest.sum() * n_bins, n_bins - 1).astype(np.int64)
        of = np.empty(N_IDS, np.int64)
        of[order] = np.r_[np.arange(HEAD_CLASSES), HEAD_CLASSES + bins]
        mass = np.maximum(np.bincount(of, weight, CLASSES), 1e-9)
        first, later = starts + 0.25, counts - starts + 0.25
        more = later.sum() / (later.sum() + first.sum())
        row = np.full(PAD + 1, OWN_ROWS + CLASSES)
        row[:N_IDS] = np.where(rank < OWN_ROWS, rank, OWN_ROWS + of)
        return Classes(
            of,
            np.log(first / np.bincount(of, first, CLASSES)[of]).astype(np.float32),
            np.log(later / later.sum()).astype(np.float32),
            row,
            np.log(mass / mass.sum()).astype(np.float32),
            np.bincount(of, starts, CLASSES),
            float(np.log(more)),
            float(np.log(1 - more)),
        )


def by_count(counts: np.ndarray) -> np.ndarray:
    """Ids by falling count, the end symbol first, which is a class of its own."""
    order = np.lexsort((np.arange(N_IDS), -counts))
    return np.r_[END_ID, order[order != END_ID]]


def company(windows: DataFrame, markers: np.ndarray) -> np.ndarray:
    """How often each id begins a word that follows one that begins with each of the ids ``markers``: a table of fixed size."""
    mark = np.full(1 << 16, len(markers))
    mark[markers] = np.arange(len(markers))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(N_IDS * len(markers), np.int64)
        for rows in opened(batches):
            before, ids = mark[rows[:, 0, :-1]], rows[:, 0, 1:]
            hit = (before < len(markers)) & (ids != PAD)
            sums += np.bincount(ids[hit].astype(np.int64) * len(markers) + before[hit], minlength=len(sums))
        sums = sums.reshape(N_IDS, len(markers))
        own = np.flatnonzero(sums.any(axis=1))
        columns = [pa.array(own.astype(np.int32)), pa.array([sums[i].tobytes() for i in own], pa.binary()), pa.array(np.ones(len(own), np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["block", "sums", "n"])

    shape = "block int, sums binary, n long"
    found = windows.mapInArrow(each, shape)
    found = found.repartition(shuffle_partitions(windows.sparkSession), "block").mapInArrow(_summed, shape)
    out = np.zeros((N_IDS, len(markers)))
    for r in found.collect():  # at most N_IDS rows
        out[r["block"]] = np.frombuffer(r["sums"], "<i8")
    return out


def topics(together: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Ids in TOPICS groups that keep like company (by the share of each marker against its share everywhere); ids
    seen too little to tell are in one more."""
    total = together.sum(axis=1)
    out = np.full(len(together), TOPICS)
    known = np.flatnonzero(total >= 20)
    if len(known) < TOPICS:
        return out
    x = together[known]
    x = np.log((x + 1) / (total[known, None] * (x.sum(axis=0) / x.sum()) + 1))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    weight = np.log(total[known])
    centres = x[[int(np.argmax(total[known]))]]
    while len(centres) < TOPICS:  # the next one is far from all before
        centres = np.vstack([centres, x[np.argmax(weight * (1 - (x @ centres.T).max(axis=1)))]])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x * weight[:, None])
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-9), centres)
    out[known] = own
    return out


class Attention:
    """Causal self-attention with a feed-forward part; input rows of ids, logits of classes."""

    SHAPES = {
        "rows": (OWN_ROWS + CLASSES + 1, DIM), "places": (WINDOW, DIM), "q": (DIM, DIM), "k": (DIM, DIM), "v": (DIM, DIM), "o": (DIM, DIM),
        "w1": (DIM, 2 * DIM), "b1": (2 * DIM,), "w2": (2 * DIM, DIM), "out": (DIM, CLASSES), "bias": (CLASSES,),
    }

    def __init__(self, weights: np.ndarray):
        self.flat = np.ascontiguousarray(weights, np.float32)
        self.p, at = {}, 0
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            self.p[name] = self.flat[at : at + n].reshape(shape)
            at += n

    @classmethod
    def start(cls, prior: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        scale = {"rows": 0.3, "places": 0.1, "b1": 0.0, "out": 0.05, "bias": 0.0}
        parts = [rng.standard_normal(shape) * scale.get(name, DIM**-0.5) for name, shape in cls.SHAPES.items()]
        parts[-1] = prior
        return np.concatenate([p.ravel() for p in parts]).astype(np.float32)

    def hidden(self, x: np.ndarray, tail: np.ndarray | None = None) -> tuple:
        """What forward and backward share, for input rows ``x`` of places' first ids and ``tail`` of their last ones."""
        p, (m, n) = self.p, x.shape
        h0 = p["rows"][x]
        if tail is not None:
            h0 += p["rows"][tail]
        h0 += p["places"][:n]
        own = h0.reshape(-1, DIM)
        each = own @ np.concatenate([p["q"] * np.float32(DIM**-0.5), p["k"], p["v"]], axis=1)
        q, k = each[:, :DIM].reshape(m, n, DIM), each[:, DIM : 2 * DIM].reshape(m, n, DIM)
        v = np.ones((m, n, DIM + 1), np.float32)  # the last column adds up the weights
        v[..., :DIM] = each[:, 2 * DIM :].reshape(m, n, DIM)
        seen = np.tri(n, dtype=np.float32)  # no place sees a later one
        s = exponentials(q @ np.ascontiguousarray(k.transpose(0, 2, 1)), longest(each[:, :DIM]) * longest(each[:, DIM : 2 * DIM]))
        s *= seen
        a = s @ v
        total = np.maximum(a[..., DIM:], 1e-30)
        a = (a[..., :DIM] / total).reshape(-1, DIM)
        h1 = own + a @ p["o"]
        r = h1 @ p["w1"]
        r += p["b1"]
        np.maximum(r, 0, out=r)
        return own, q, k, v[..., :DIM], s, total, a, h1, r, h1 + r @ p["w2"]

    def log_classes(self, x: np.ndarray, target: np.ndarray, tail: np.ndarray | None = None) -> np.ndarray:
        """log P(class ``target``) after each position."""
        z = self.logits(self.hidden(x, tail)[-1])
        own = z[np.arange(len(z)), target.ravel()] / np.maximum(z @ np.ones(CLASSES, np.float32), 1e-30)
        return np.log(np.maximum(own, 1e-30)).reshape(target.shape)

    def logits(self, h: np.ndarray) -> np.ndarray:
        """exp of the classes' logits, up to a factor for each row."""
        p = self.p
        return exponentials(h @ p["out"] + p["bias"], longest(h) * longest(p["out"].T) + float(np.abs(p["bias"]).max()))

    def gradient(self, x: np.ndarray, target: np.ndarray, mask: np.ndarray, tail: np.ndarray | None = None) -> np.ndarray:
        """Of the mean cross entropy over the positions in ``mask``."""
        p, (m, n) = self.p, x.shape
        h0, q, k, v, s, total, a, h1, r, h2 = self.hidden(x, tail)
        z = self.logits(h2)
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(len(z)), target.ravel()] -= 1
        z *= (mask / np.float32(max(1, mask.sum()))).reshape(-1, 1)
        g = {"out": h2.T @ z, "bias": z.sum(axis=0)}
        d2 = z @ p["out"].T
        g["w2"] = r.T @ d2
        dr = (d2 @ p["w2"].T) * (r > 0)
        g["w1"], g["b1"] = h1.T @ dr, dr.sum(axis=0)
        d1 = d2 + dr @ p["w1"].T
        g["o"] = a.T @ d1
        da = (d1 @ p["o"].T).reshape(m, n, DIM)
        s /= total
        ds = da @ v.transpose(0, 2, 1)
        ds -= (da * a.reshape(m, n, DIM)).sum(axis=2, keepdims=True)
        ds *= s
        scale = np.float32(DIM**-0.5)
        dq, dk, dv = ((d).reshape(-1, DIM) for d in ((ds @ k) * scale, ds.transpose(0, 2, 1) @ q, s.transpose(0, 2, 1) @ da))
        d0 = d1 + dq @ p["q"].T + dk @ p["k"].T + dv @ p["v"].T
        for name, d in (("q", dq), ("k", dk), ("v", dv)):
            g[name] = h0.T @ d
        g["places"] = np.zeros_like(p["places"])
        g["places"][:n] = d0.reshape(m, n, DIM).sum(axis=0)
        g["rows"] = np.zeros_like(p["rows"])
        rows = (x if tail is None else np.concatenate([x, tail])).astype(np.uint16).ravel()
        order = np.argsort(rows, kind="stable")
        own = rows[order]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        g["rows"][own[first]] = np.add.reduceat(d0[order % len(d0)], first, axis=0)
        return np.concatenate([g[name].ravel() for name in self.SHAPES])


def exponentials(z: np.ndarray, most: float) -> np.ndarray:
    """exp of rows of logits, up to a factor for each row, in place. ``most`` bounds them; only if that is
    too much for exp are rows moved down by their largest."""
    if most > 80:
        z -= z.max(axis=-1, keepdims=True)
    return np.exp(z, out=z)


def longest(rows: np.ndarray) -> float:
    """The largest norm of a row."""
    return float(np.sqrt(np.einsum("ij,ij->i", rows, rows).max(initial=0)))


def trained(weights: np.ndarray, windows: np.ndarray, classes: Classes, rate: float) -> np.ndarray:
    """Weights after a pass of Adam over ``windows`` (n, 2, WINDOW + 1); more passes if there are
    few, to make at least MIN_STEPS steps."""
    one_blas_thread()
    model = Attention(weights.copy())
    m, v = np.zeros_like(model.flat), np.zeros_like(model.flat)
    step_, root = np.empty_like(m), np.empty_like(m)
    starts = range(0, len(windows), BATCH)
    for step in range(1, max(MIN_STEPS, len(starts)) + 1):
        at = starts[(step - 1) % len(starts)]
        heads, tails = windows[at : at + BATCH, 0], windows[at : at + BATCH, 1]
        mask = heads[:, 1:] != PAD
        n = int(mask.any(axis=0).sum())
        of = classes.of[np.where(mask, heads[:, 1:], START_ID)[:, :n]]
        g = model.gradient(classes.row[heads[:, :n]], of, mask[:, :n].astype(np.float32), classes.row[tails[:, :n]])
        np.subtract(g, m, out=step_)
        step_ *= 0.1
        m += step_
        g *= g
        g -= v
        g *= 0.01
        v += g
        np.divide(v, 1 - 0.99**step, out=root)
        np.sqrt(root, out=root)
        root += 1e-8
        np.divide(m, 1 - 0.9**step, out=step_)
        step_ *= np.float32(rate)
        step_ /= root
        model.flat -= step_
    return model.flat


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, sums, n), one for each block: integer sums, the same in any order."""
    held: dict[int, np.ndarray] = {}
    weight: dict[int, int] = {}
    for batch in batches:
        for block, sums, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held[block] = held.get(block, 0) + np.frombuffer(sums, "<i8")
            weight[block] = weight.get(block, 0) + n
    columns = [pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary()), pa.array(list(weight.values()), pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["block", "sums", "n"])


def _fitter(shared, part: int, rate: float):
    """Trains each group on its windows of a round, from the broadcast weights on; gives the sums of all new weights in blocks."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, classes = shared.value
        classes, sums, n = Classes(*classes), np.zeros(len(weights), np.int64), 0
        for group in opened(batches):
            rows = group[part::ROUNDS]
            if len(rows):
                sums += np.rint(trained(weights, rows, classes, rate).astype(np.float64) * (1 << SCALE)).astype("<i8") * len(rows)
                n += len(rows)
        if n:
            parts = [sums[a : a + BLOCK].tobytes() for a in range(0, len(sums), BLOCK)]
            columns = [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary()), pa.array([n] * len(parts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "sums", "n"])

    return fit


def train(spark: SparkSession, windows: DataFrame, classes: Classes, rate: float = RATE) -> np.ndarray:
    """The network's weights, from ``windows`` (n, windows)."""
    weights = Attention.start(classes.prior)
    shape = "block int, sums binary, n long"
    for r in range(ROUNDS):
        fit = _fitter(spark.sparkContext.broadcast((weights, classes.arrays())), r, rate * (1 - r / ROUNDS))
        sums = windows.mapInArrow(fit, shape)
        blocks = sums.repartition(shuffle_partitions(spark), "block").mapInArrow(_summed, shape).collect()  # of fixed number
        if blocks:
            blocks.sort(key=lambda x: x["block"])
            weights = np.concatenate([np.frombuffer(x["sums"], "<i8") / x["n"] / (1 << SCALE) for x in blocks]).astype(np.float32)
    return weights


def scored(
    model: Attention, classes: Classes, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, tails: np.ndarray | None = None
) -> np.ndarray:
    """log P(class of the id | ids before it) of the ids in ``flat``, the first ones of words (``tails``: the last ones, or PAD);
    documents are flat[starts:ends]."""
    out = np.zeros(len(flat), np.float32)
    size = ends - starts
    n = 1 + np.maximum(0, -(-(size - WINDOW) // (WINDOW - OVERLAP)))  # windows of each document
    n[size == 0] = 0
    doc = np.repeat(np.arange(len(size)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = starts[doc] + nth * (WINDOW - OVERLAP)  # the first id that the window predicts
    length = np.minimum(ends[doc] - first, WINDOW)
    skip = np.where(nth > 0, OVERLAP, 0)  # scored by the window before
    of = classes.of[flat]
    before, tail_before = np.r_[classes.row[START_ID], classes.row[flat][:-1]], None
    before[starts[size > 0]] = classes.row[START_ID]
    if tails is not None:
        tail_before = np.r_[classes.row[PAD], classes.row[tails][:-1]]
        tail_before[starts[size > 0]] = classes.row[PAD]
    order = np.argsort(length, kind="stable")  # windows of like length go together
    for a in range(0, len(order), SCORE_BATCH):
        some = order[a : a + SCORE_BATCH]
        inner = np.arange(int(length[some[-1]]))
        use = (inner < length[some, None]) & (inner >= skip[some, None])
        place = np.minimum(first[some, None] + inner, len(flat) - 1)
        found = model.log_classes(before[place], of[place], None if tails is None else tail_before[place])
        out[place[use]] = found[use]
    return out


def _counted(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    """From word lists sorted by bucket, ``REPLIES``: what each chunk gets back (kind 3: codes, counts, numbers of ids and ids, compressed;
    n: words), and of the task's words the counts of ids (4), sums (5: occurrences, kinds, kinds that occur once) and pairs of ids in a row (6)."""
    ids_of = per_worker(f"word ids {tokenizer}", lambda: word_ids(tokenizer))
    codec = pa.Codec("zstd", 1)
    every, first = np.zeros(N_IDS, np.int64), np.zeros(N_IDS, np.int64)
    n_words = n_kinds = n_once = 0
    names = [f.split()[0] for f in REPLIES.split(", ")]
    kinds = [pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.binary()]
    follows: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in sorted_groups(batches, 1):
        bucket = np.asarray(batch.column(0))
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            numbers, which, pairs = _Numbers(), [], []
            for size, body, both in zip(*(batch.column(k).slice(a, b - a).to_pylist() for k in (2, 3, 4)), strict=True):
                words = codec.decompress(body, size, asbytes=True).split(b"\n")
                which.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                pairs.append(np.frombuffer(both, "<u4").reshape(2, -1))
            c = np.bincount(np.concatenate(which), np.concatenate([p[1] for p in pairs]), len(numbers)).astype(np.int64)
            flat, many = ids_of(list(numbers))
            at = np.cumsum(many) - many
            np.add.at(every, flat, np.repeat(c, many))
            np.add.at(first, flat[at], c)
            inner = np.ones(len(flat), bool)
            inner[at] = False
            inner = np.flatnonzero(inner)
            follows.append(added([(flat[inner - 1].astype(np.int64) << 16 | flat[inner], np.repeat(c, many)[inner])]))
            if len(follows) >= 64:
                follows = [added(follows)]
            n_words, n_kinds, n_once = n_words + int(c.sum()), n_kinds + int((c > 0).sum()), n_once + int((c == 1).sum())
            out = []
            for own, (codes, _) in zip(which, pairs, strict=True):
                lens = many[own]
                place = np.arange(lens.sum()) + np.repeat(at[own] - np.cumsum(lens) + lens, lens)
                raw = codes.tobytes() + c[own].astype("<i8").tobytes() + lens.astype("<u4").tobytes() + flat[place].tobytes()
                out.append((len(own), len(raw), codec.compress(raw, asbytes=True)))
            n, sizes, bodies = zip(*out, strict=True)
            none = pa.nulls(len(n), pa.int64())
            three = pa.array(np.full(len(n), 3, np.int32))
            columns = [three, batch.column(1).slice(a, b - a), pa.array(n, pa.int64()), none, pa.array(sizes, pa.int64()), pa.array(bodies, pa.binary()), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
    keys, times = added(follows)
    packed = keys.astype("<i8").tobytes() + times.astype("<i8").tobytes()
    own = np.flatnonzero(every).tolist()
    rows = [(4, i, int(every[i]), int(first[i]), None, None, None) for i in own] + [(5, None, n_words, n_kinds, n_once, None, None)]
    rows.append((6, None, None, None, None, None, packed))
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys, own = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, own, np.concatenate([n for _, n in parts]))
    return keys, sums


def following(replies: DataFrame, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pieces within the training words: (class of the piece before * N_IDS + id, how often), at most CLASSES * N_IDS."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                keys, times = np.frombuffer(raw, "<i8").reshape(2, -1)
                parts = [added([*parts, (of[keys >> 16] * N_IDS + (keys & 0xFFFF), times)])]
        keys, times = added(parts)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], ["key", "times"])

    rows = replies.where("pairs is not null").select("pairs").mapInArrow(each, "key long, times long")
    table = rows.groupBy("key").agg(F.sum("times").alias("times")).where("times > 0").toArrow()
    keys, times = np.asarray(table["key"]), np.asarray(table["times"])
    order = np.argsort(keys)
    return keys[order], times[order]


def _word_list(lists: pa.Table, codec: pa.Codec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, numbers of ids, ids end to end) of a chunk's words, by code."""
    parts = []
    for n, size, body in zip(*(lists[c].to_pylist() for c in ("n", "size", "body")), strict=True):
        raw = codec.decompress(body, size, asbytes=True)
        parts.append([np.frombuffer(raw[a:b], t) for a, b, t in ((0, 4 * n, "<u4"), (4 * n, 12 * n, "<i8"), (12 * n, 16 * n, "<u4"), (16 * n, None, "<u2"))])
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u2")
    codes, c, many, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
    many, order = many.astype(np.int64), np.argsort(codes)
    at = (np.cumsum(many) - many)[order]
    many = many[order]
    return c[order], many, flat[np.arange(many.sum()) + np.repeat(at - np.cumsum(many) + many, many)]


def score(
    spark: SparkSession, documents: DataFrame, tokenizer_path: str | None = None, rate: float = RATE
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document (see the module)."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    table = chunks(documents, tokenizer_path, shuffle_partitions(spark) * BUCKETS)
    n_docs = table.where("kind = 0 and not held_out").count()
    counts, begin = np.zeros(N_IDS, np.int64), np.zeros(N_IDS, np.int64)
    by_id = table.where("kind = 4").groupBy("chunk").agg(F.sum("n").alias("n"), F.sum("begin").alias("b"))
    for r in by_id.collect():  # at most N_IDS rows
        counts[r["chunk"]], begin[r["chunk"]] = r["n"], r["b"]
    counts[END_ID] = begin[END_ID] = n_docs
    n_words, n_kinds, once = table.where("kind = 5").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "begin", "size")]).first()
    total, kinds = n_words + n_docs, n_kinds + (n_docs > 0)
    known = 1 - min(0.5, max(once / max(1, n_words), 1e-4))
    windows = table.where("windows is not null").select("n", "windows")
    classes = Classes.fit(counts, begin, topics(company(windows, by_count(begin)[1 : MARKERS + 1])))
    weights = train(spark, windows, classes, rate)
    shared = spark.sparkContext.broadcast((weights, classes.arrays(), following(table, classes.of)))
    below = np.log10(total + 0.1 * (kinds + 1))

    def rate_chunk(docs: pa.Table, lists: pa.Table) -> pa.Table:
        one_blas_thread()
        weights, classes, (seen, times) = shared.value
        model, classes, codec = Attention(weights), Classes(*classes), pa.Codec("zstd")
        # the chunk's words by code, then the end symbol
        c, many, pieces = _word_list(lists, codec)
        n = len(c)
        c, many, pieces = np.r_[c, n_docs], np.r_[many, 1], np.r_[pieces, np.uint16(END_ID)]
        at = np.cumsum(many) - many
        heads = pieces[at]
        tails = np.where(many > 1, pieces[at + many - 1], np.uint16(PAD))
        base = np.log10(c + 0.1) - below
        first_class = classes.of[heads]
        with np.errstate(divide="ignore"):
            as_known = np.log(known * c / np.maximum(1, classes.begin[first_class]))
        as_known[n] = 0.0  # the end symbol is its class
        own = as_known  # within the class of the first id
        unknown = (c == 0) & (np.arange(n + 1) != n)
        if unknown.any():
            flat = pieces[np.repeat(unknown, many)]
            begins = np.cumsum(many[unknown]) - many[unknown]
            before = classes.of[np.r_[flat[:1], flat[:-1]]]
            key = before * N_IDS + flat
            place = np.searchsorted(seen, key)
            hit = np.r_[seen, -1][place] == key
            total = np.bincount(seen // N_IDS, times, CLASSES) if len(seen) else np.zeros(CLASSES)
            share = np.exp(classes.later[flat].astype(np.float64))
            later = np.log((np.where(hit, np.r_[times, 0][place], 0) + SMOOTH * share) / (total[before] + SMOOTH))
            later[begins] = 0.0
            more = classes.more * (many[unknown] - 1) + classes.no_more
            own[unknown] = np.log(1 - known) + classes.first[flat[begins]] + np.add.reduceat(later, begins) + more
        docs = docs.sort_by([("size", "ascending"), ("doc_id", "ascending")])
        size = np.asarray(docs["size"])
        bodies = docs["body"].to_pylist()
        out = [], [], [], []
        a = 0
        while a < len(size):  # as many documents as have CHUNK_WORDS / 8 words, or one
            b = a + max(1, int(np.searchsorted(np.cumsum(size[a:] + 1), CHUNK_WORDS >> 3)))
            codes = [
                np.r_[np.frombuffer(codec.decompress(x, 4 * int(s), asbytes=True), "<u4") if s else np.empty(0, "<u4"), np.uint32(n)]
                for x, s in zip(bodies[a:b], size[a:b], strict=True)
            ]
            tokens = np.concatenate(codes).astype(np.int64)
            doc_at = np.cumsum(size[a:b] + 1) - (size[a:b] + 1)
            ends = np.r_[doc_at[1:], len(tokens)]
            log_p = scored(model, classes, heads[tokens], doc_at, ends, tails[tokens]).astype(np.float64) + own[tokens]
            out[0].append(size[a:b] + 1)
            out[1].append(np.add.reduceat((c[tokens] > 0).astype(np.int64), doc_at))
            out[2].append(np.add.reduceat(base[tokens], doc_at))
            out[3].append(np.add.reduceat(log_p, doc_at) / np.log(10))
            a = b
        whole = [pa.array(np.concatenate(x)) for x in out]
        names = ("n_tokens", "n_known", "base_score", "score")
        return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"]} | dict(zip(names, whole, strict=True)))

    # columns of its own: both sides of the cogroup come from one table
    lists = table.where("kind = 3").select(*[F.col(c).alias(c) for c in ("chunk", "n", "size", "body")])
    docs = table.where("kind = 0").select(F.col("chunk").alias("of"), "doc_id", "held_out", "size", "body")
    shape = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    rows = docs.groupBy("of").cogroup(lists.groupBy("chunk")).applyInArrow(rate_chunk, shape)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
