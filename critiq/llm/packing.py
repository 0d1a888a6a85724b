"""Best-fit packing of token pieces into sequences, reduced by Martello-Toth dominance.

Every document becomes token ids and an end id; longer ones are cut into pieces of
the capacity. Pieces are packed whole. Only lengths matter to a packing, so it is
planned on the histogram of lengths, which has at most ``capacity`` rows however many
documents there are, and pieces then find their place by their rank among
the pieces of their length.

Dominance fixes small sets of pieces for good when some optimal packing has
them. For a piece j and the longest piece k that still fits with it, {j, k} is fixed if

* j and k fill a sequence exactly: whatever else might go with j is no longer than k;
* only one piece can go with j (j and the two shortest pieces are too long): k is
  the best one;
* at most two can go with j (j and the three shortest are too long) and k is at least as
  long as any two that fit together with j.

A piece that nothing fits with is fixed alone. In each case the pieces that another
packing puts with j can change places with k. What is left is packed longest first,
each piece into the fullest sequence that has room (best fit decreasing).

Pieces of a length are alike, so both steps move counts, not pieces: a plan row puts
``per`` pieces of one length into each of a run of sequences.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from critiq.llm.common import per_worker, pieces, staged, text_bytes, words_in

CAPACITY = 4096
END_ID = 1
#: Words after which a task's memory of ids starts a new generation (it keeps two), and the
#: longest word it remembers.
CACHED_WORDS, CACHED_BYTES = 300_000, 48
#: Punctuation that closes words of letters.
MARKS = ".,;:!?"
#: Texts whose words are looked up together.
TEXTS = 1000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes as: printable Latin-1 as itself, the
    rest from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


def word_encoder(tokenizer_path: str, cached_words: int = CACHED_WORDS):
    """ids of a UTF-8 text as little-endian unsigned 32-bit bytes.

    For tokenizers that drop white space, so that a text's ids are its words' ids in a row. A word of
    Latin letters with closing punctuation, which such tokenizers part, lower-case and write in byte
    letters, goes straight to the model, if that gives the tokenizer's ids for a set of trial words.
    Any other run between white space goes to the tokenizer as it is. Both are remembered up to a bound.
    """
    import re
    from array import array

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    model, letters = tokenizer.model, _byte_letters()
    young: dict[str, bytes] = {}
    old: dict[str, bytes] = {}
    # precomposed letters that normalize to themselves and have one lower-case letter
    plain = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+)([" + MARKS + "]*)")

    def whole(words: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(f.ids, "<u4").tobytes() for f in found]

    def direct(word: str) -> bytes:
        written = word if word.isascii() else word.encode().decode("latin-1").translate(letters)
        return array("I", [t.id for t in model.tokenize(written)]).tobytes()

    def of_run(run: str) -> bytes:
        found = older.get(run)
        runs[run] = found = direct(run) if found is None else found
        return found

    def of_marks(marks: str) -> bytes:
        marked[marks] = found = direct(marks)
        return found

    # ids of lower-case runs of letters (two generations), of punctuation, and of all other words (two generations)
    runs: dict[str, bytes] = {}
    older: dict[str, bytes] = {}
    marked: dict[str, bytes] = {}
    trial = "The,words isn't, \u00dcber \u00c9t\u00e9!? na\u00efve \u0141\u00f3d\u017a \u0152uvre... Kurz: antidisestablishmentarianism;".split()
    try:
        matches = [plain.fullmatch(w) for w in trial]
        trusted = all(
            m is None or direct(m[1].lower()) + (direct(m[2]) if m[2] else b"") == ids for m, ids in zip(matches, whole(trial), strict=True)
        )
    except Exception:  # noqa: BLE001 - a model that does not take byte letters
        trusted = False

    def other(words: list[str]) -> list[bytes]:
        nonlocal young, old
        if len(young) > cached_words:
            young, old = {}, young
        found = [young.get(w) for w in words]
        found = [old.get(w) if f is None else f for w, f in zip(words, found, strict=True)]
        new = list(dict.fromkeys([w for w, f in zip(words, found, strict=True) if f is None]))
        more = dict(zip(new, whole(new), strict=True))
        found = [more[w] if f is None else f for w, f in zip(words, found, strict=True)]
        young.update((w, f) for w, f in zip(words, found, strict=True) if len(w) <= CACHED_BYTES)
        return found

    def each(words: list[bytes]) -> list[bytes]:
        nonlocal runs, older, marked
        if not words:
            return []
        if len(runs) > cached_words:
            runs, older = {}, runs
        if len(marked) > cached_words:
            marked = {}
        written = b"\n".join(words).decode("utf-8", "replace").split("\n")
        if not trusted:
            return other(written)
        out, rest = [b""] * len(words), []
        for i, word in enumerate(written):
            run = word.rstrip(MARKS)
            found = runs.get(run)  # only what has matched before is there
            if found is None:
                if len(words[i]) > CACHED_BYTES or plain.fullmatch(word) is None:
                    rest.append(i)
                    continue
                run_lower = run.lower()
                found = runs.get(run_lower)
                if found is None:
                    found = of_run(run_lower)
            if len(run) < len(word):
                if len(words[i]) > CACHED_BYTES:
                    rest.append(i)
                    continue
                marks = word[len(run) :]
                more = marked.get(marks)
                found += of_marks(marks) if more is None else more
            out[i] = found
        for i, ids in zip(rest, other([written[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def many(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        words, n = words_in(texts)
        coded = words.dictionary_encode()  # each word is looked up once for all texts
        found = each(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        flat, begins = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        which = np.asarray(coded.indices)
        size, ends = size[which], np.cumsum(size[which])
        at = np.repeat(begins[which] - (ends - size), size)
        at += np.arange(len(at))
        return flat[at], np.diff(np.r_[0, ends][np.r_[0, np.cumsum(n)]])

    def ids(text: bytes) -> bytes:
        return b"".join(each(text.split()))

    ids.each = each  # of a list of words, the ids of each
    ids.many = many  # of a list of texts, the ids of all, end to end, and how many each has
    # the model's pieces of letters, and the words that are letters and punctuation, if they may go to the model
    ids.model, ids.letters, ids.plain = (model, letters, plain) if trusted else (None, None, None)
    return ids


def token_pieces(
    documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, cached_words: int = CACHED_WORDS
) -> DataFrame:
    """One row (``PIECES``) for each piece. ``nth`` numbers the pieces of one length in one ``task``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import zlib
        from collections import Counter

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = per_worker(f"ids {tokenizer_path}", lambda: word_encoder(tokenizer_path, cached_words))
        end = np.array([end_id], "<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in pieces(batches):
            rows = []
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                flat, many = ids.many(list(text_bytes(part.column(1))))
                upto = 0
                for doc_id, n in zip(part.column(0).to_pylist(), many.tolist(), strict=True):
                    tokens, upto = flat[upto : upto + n].tobytes() + end, upto + n
                    for k, start in enumerate(range(0, len(tokens), 4 * capacity)):
                        piece = tokens[start : start + 4 * capacity]
                        length = len(piece) // 4
                        rows.append((doc_id, k, start // 4, length, zlib.crc32(piece), task, seen[length]))
                        seen[length] += 1
            columns = zip(*rows, strict=True) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    names = [f.split()[0] for f in PIECES.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[f.split()[1]]) for n, f in zip(names, PIECES.split(", "), strict=True)])
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


class Plan:
    """Rows (length, first rank, pieces, first sequence, per sequence, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = {w: n for w, n in sorted(counts.items()) if n > 0}
        self.lengths = list(self.left)  # ascending, those that are left
        self.used = dict.fromkeys(self.left, 0)
        self.capacity, self.sequences, self.rows = capacity, 0, []
        self.n_fixed = 0

    def place(self, w: int, n: int, first: int, per: int, offset: int) -> None:
        self.rows.append((w, self.used[w], n, first, per, offset))
        self.used[w] += n
        self.left[w] -= n
        if not self.left[w]:
            del self.left[w]
            self.lengths.remove(w)

    def shortest(self, n: int, but: int) -> int:
        """Sum of the n shortest pieces left, one piece of length ``but`` aside; more than
        the capacity if there are not so many."""
        total = 0
        for w in self.lengths:
            have = min(n, self.left[w] - (w == but))
            total, n = total + have * w, n - have
            if not n:
                return total
        return self.capacity + 1

    def fix(self, j: int, k: int | None) -> None:
        """Fix as many sequences of j and k (of j alone) as there are."""
        n = self.left[j] if k is None else self.left[j] // 2 if k == j else min(self.left[j], self.left[k])
        first = self.sequences
        if k == j:
            self.place(j, 2 * n, first, 2, 0)
        else:
            self.place(j, n, first, 1, 0)
            if k is not None:
                self.place(k, n, first, 1, j)
        self.sequences += n
        self.n_fixed += n

    def mate(self, j: int) -> int | None:
        """The longest piece that fits with j, other than j itself."""
        at = bisect_left(self.lengths, self.capacity - j + 1) - 1
        if at >= 0 and self.lengths[at] == j and self.left[j] < 2:
            at -= 1
        return self.lengths[at] if at >= 0 else None

    def best_two(self, j: int) -> int:
        """The largest sum of two other pieces that fit with j; 0 if none do."""
        others = [w for w in self.lengths if w != j or self.left[j] > 1]
        room, best, low, high = self.capacity - j, 0, 0, len(others) - 1
        while low <= high:
            a, b = others[low], others[high]
            if a + b > room:
                high -= 1
                continue
            if a != b or self.left[a] - (a == j) > 1:
                best = max(best, a + b)
            low += 1
        return best

    def reduce(self) -> None:
        """Fix dominating sets, longest pieces first, until none is left."""
        for j in self.lengths[::-1]:  # exact fits can be fixed anywhere, at any time
            k = self.capacity - j
            if not k and j in self.left:
                self.fix(j, None)
            elif j in self.left and k in self.left and (j != k or self.left[j] > 1):
                self.fix(j, k)
        changed = True
        while changed:
            changed = False
            for j in self.lengths[::-1]:
                while j in self.left:
                    k = self.mate(j)
                    if k is None:
                        self.fix(j, None)
                    elif self.dominates(j, k):
                        self.fix(j, k)
                    else:
                        break
                    changed = True
                if j in self.left and j + self.shortest(3, j) <= self.capacity:
                    break  # three fit with every shorter one too

    def dominates(self, j: int, k: int) -> bool:
        """Whether {j, k} can be fixed; holds on as pieces go, until j or k runs out."""
        if j + k == self.capacity or j + self.shortest(2, j) > self.capacity:
            return True
        if j + self.shortest(3, j) <= self.capacity:
            return False
        return k >= self.best_two(j)

    def best_fit(self) -> None:
        """Best fit decreasing. A class (room, first, n) is a run of n open sequences with equal room."""
        open_: list[tuple[int, int, int]] = []
        while self.lengths:
            w = self.lengths[-1]
            at = bisect_left(open_, (w, -1, -1))
            if at == len(open_):  # fits nowhere: as many new sequences as it needs
                n = -(-self.left[w] // (self.capacity // w))
                insort(open_, (self.capacity, self.sequences, n))
                self.sequences += n
                continue
            room, first, n = open_.pop(at)
            per = room // w
            whole, rest = divmod(min(self.left[w], n * per), per)
            for m, each, start in ((whole, per, first), (1 if rest else 0, rest, first + whole)):
                if m:
                    self.place(w, m * each, start, each, self.capacity - room)
                    insort(open_, (room - each * w, start, m))
            done = whole + (1 if rest else 0)
            if done < n:
                insort(open_, (room, first + done, n - done))

    def run(self) -> Plan:
        self.reduce()
        self.best_fit()
        return self


def pack(
    spark: SparkSession,
    documents: DataFrame,
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    Texts are tokenized once and leave as narrow rows in the shared folder. The
    histogram (at most ``capacity`` rows) is planned on the driver; the plan's size depends on
    the capacity, not on the documents. A piece's rank is its number in its task plus the
    pieces of its length in earlier tasks, so no length, however common, is gathered anywhere.

    Defined cases: null and empty texts are one piece, the end id; rows that share a doc_id, null
    or not, are packed each on its own; an empty table gives an empty result; other
    columns are ignored; texts of any length are cut into pieces.
    """
    pieces = staged(spark, token_pieces(documents, tokenizer_path or default_tokenizer(), capacity, end_id, cached_words), "pieces")
    by_task = staged(spark, pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(counts, capacity).run()
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    before = by_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # one row for each task and length: it grows with the input, so it is never broadcast, however small its file
    ranked = pieces.join(before.hint("merge"), ["task", "length"])
    rows = np.array(sorted(plan.rows), np.int64).reshape(-1, 6)
    places = spark.sparkContext.broadcast(rows)

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first_rank, _, first_sequence, per, offset = places.value.T
        for batch in batches:
            w, nth, before = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "nth", "before"))
            rank = nth + before
            at = _last_at_or_before(length, first_rank, w, rank)
            k = rank - first_rank[at]
            out = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            out += [pa.array(first_sequence[at] + k // per[at]), pa.array(offset[at] + k % per[at] * w)]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(
        seat, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def _last_at_or_before(lengths: np.ndarray, ranks: np.ndarray, w: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Index of the last plan row of length w whose first rank is at most rank."""
    low = np.searchsorted(lengths, w, "left")
    high = np.searchsorted(lengths, w, "right")
    out = np.empty(len(w), np.int64)
    for length in np.unique(w):
        of = w == length
        a, b = low[of][0], high[of][0]
        out[of] = a + np.searchsorted(ranks[a:b], rank[of], "right") - 1
    return out
