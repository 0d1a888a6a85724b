"""Toxicity classifier: character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams of a lower-cased text, hashed into a fixed
number of buckets. Over the training texts each bucket gets the ratio
r = log(((p + 1) / (P + 2)) / ((q + 1) / (Q + 2))): p of the P toxic and q of the Q other training texts
have it. The buckets that tell the classes apart best are kept, and a logistic regression is
trained on features of value r. A text's score is that regression's probability.

Training uses a bounded sample, at most ``per_class`` labelled documents of each class, those
with the smallest hash of their id, and one row of each (of rows that share a labelled id the text of the smallest hash). It is
written once to the shared folder; what is sent to the driver are its rows' features and ``n_features`` buckets. Scoring reads every text whole, in one narrow pass.

Defined cases: null and empty texts have no features and get the score of the intercept;
a label row with a null id or label is no label, and a document labelled more than once is toxic if any
of its rows says so; without labelled texts of both classes every score is 0 if no toxic
label is known, else 1; rows are scored by text alone, so repeated rows score alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from critiq.llm.common import staged, text_bytes

N_GRAMS = (3, 4, 5)
BUCKET_BITS = 20
PER_CLASS = 6000
N_FEATURES = 4096
MIN_DOCUMENTS = 4
#: Buckets whose log-count ratio is nearer to 0 than this say more about a text's length and language.
MIN_RATIO = 0.7
FOLDS = 5
BLOCK_CHARS = 1 << 20
#: An odd random multiplier for each character of an n-gram.
_MULTIPLIERS = [int(m) | 1 for m in np.random.default_rng(17).integers(0, 2**63, max(N_GRAMS), np.uint64)]


def gram_buckets(text: bytes | None) -> Iterator[np.ndarray]:
    """Buckets of a text's character n-grams, block by block, repeats included."""
    chars = (text or b"").decode("utf-8", "replace").lower()
    for at in range(0, len(chars), BLOCK_CHARS):
        block = chars[at : at + BLOCK_CHARS + max(N_GRAMS) - 1].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(block, "<u4").astype(np.uint64)
        shares = [codes * np.uint64(m) for m in _MULTIPLIERS]
        for n in N_GRAMS:
            if len(codes) < n:
                break
            last = len(codes) - n + 1
            mixed = shares[0][:last].copy()
            for k in range(1, n):
                mixed += shares[k][k : k + last]
            mixed += np.uint64(n * 0x632BE59BD9B4E019 & (2**64 - 1))
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            yield (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def text_features(text: bytes | None, wanted: np.ndarray | None = None) -> np.ndarray:
    """Distinct buckets of a text, ascending; only those ``wanted`` (flags) if given."""
    parts = [b if wanted is None else b[wanted[b]] for b in gram_buckets(text)]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int64)


@dataclass(frozen=True)
class Model:
    buckets: np.ndarray  # ascending
    weights: np.ndarray  # regression weight times log-count ratio
    intercept: float

    def scores(self, texts) -> np.ndarray:
        flags = np.zeros(1 << BUCKET_BITS, bool)
        flags[self.buckets] = True
        weight = np.zeros(1 << BUCKET_BITS)
        weight[self.buckets] = self.weights
        z = np.array([self.intercept + weight[text_features(t, flags)].sum() for t in texts])
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def held_out(doc_id: Column) -> Column:
    """Whether a document is of the fold that labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_sample(documents: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """``text, toxic`` of at most per_class labelled documents of each class, none held out.

    The chosen ids are at most 2 * per_class and so are broadcast; each task passes on one row of an id at most.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("labelled_id is not null and toxic in (0, 1)")
        .where(~held_out(F.col("labelled_id")))
        .groupBy("labelled_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = [F.xxhash64(F.col("labelled_id")), F.col("labelled_id")]
    chosen = [known.where(F.col("toxic") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    own = documents.select(F.col("doc_id").cast("long").alias("own_id"), "text")
    found = own.join(F.broadcast(chosen[0].union(chosen[1])), F.col("own_id") == F.col("labelled_id"))
    nth = F.row_number().over(Window.partitionBy("own_id").orderBy(F.xxhash64("text"), "text"))
    return found.withColumn("nth", nth).where("nth = 1").select("text", "toxic")


def bucket_counts(sample: DataFrame) -> DataFrame:
    """``bucket, p, q``: toxic and other documents that have it. A task adds up all its
    documents, in two arrays, before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            for text, toxic in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found[toxic, text_features(text)] += 1
        some = np.flatnonzero(found.any(axis=0))
        columns = [pa.array(some), pa.array(found[1, some]), pa.array(found[0, some])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "p", "q"])

    return (
        sample.mapInArrow(count, "bucket long, p long, q long")
        .groupBy("bucket")
        .agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    )


def logistic(indices: np.ndarray, starts: np.ndarray, values: np.ndarray, y: np.ndarray, l2: float, steps: int):
    """Weights and intercept of an L2 regularised logistic regression with classes of equal
    total weight, by Adam on the full sample. Rows are runs of ``indices`` from ``starts`` on."""
    row = np.repeat(np.arange(len(y)), np.diff(np.r_[starts, len(indices)]))
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, m, v = (np.zeros(len(values) + 1) for _ in range(3))  # the last is the intercept
    scaled = values[indices]
    for t in range(1, steps + 1):
        z = w[-1] + np.bincount(row, w[indices] * scaled, len(y))
        error = share * (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y)
        grad = np.r_[np.bincount(indices, error[row] * scaled, len(values)) + l2 * w[:-1], error.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w[:-1], w[-1]


def train(
    spark: SparkSession,
    documents: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    n_features: int = N_FEATURES,
    l2: float = 1e-4,
    steps: int = 300,
) -> Model:
    sample = staged(spark, training_sample(documents, labels, per_class), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        return Model(np.empty(0, np.int64), np.empty(0), 40.0 if n_toxic else -40.0)
    p, q = (F.col("p") + 1) / (n_toxic + 2), (F.col("q") + 1) / (n_other + 2)
    # both classes' shares apart, in standard errors
    z = F.abs(p - q) / F.sqrt(p * (1 - p) / n_toxic + q * (1 - q) / n_other)
    best = (
        bucket_counts(sample)
        .where(F.col("p") + F.col("q") >= MIN_DOCUMENTS)
        .select("bucket", F.log(p / q).alias("r"), z.alias("z"))
        .where(F.abs("r") >= MIN_RATIO)
        .orderBy(F.desc("z"), "bucket")
        .limit(n_features)
        .toPandas()
        .sort_values("bucket")
    )
    buckets, ratios = best["bucket"].to_numpy(np.int64), best["r"].to_numpy(float)
    flags = np.zeros(1 << BUCKET_BITS, bool)
    flags[buckets] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(t, flags) for t in text_bytes(batch.column(0))]
            column = pa.array([np.searchsorted(buckets, f).astype(np.int32).tobytes() for f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([column, batch.column(1)], ["features", "toxic"])

    matrix = sample.mapInArrow(rows, "features binary, toxic int").toPandas()
    found = [np.frombuffer(f, np.int32) for f in matrix["features"]]
    order = sorted(range(len(found)), key=lambda i: (matrix["toxic"][i], found[i].tobytes()))  # reruns agree
    found, y = [found[i] for i in order], matrix["toxic"].to_numpy()[order]
    starts = np.cumsum([0, *map(len, found)])[:-1]
    weights, intercept = logistic(np.concatenate(found), starts, ratios, y, l2, steps)
    return Model(buckets, weights * ratios, float(intercept))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``documents`` (doc_id, text)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.scores(text_bytes(batch.column(1))), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])

    scored = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def classify(spark: SparkSession, documents: DataFrame, labels: DataFrame, **how) -> DataFrame:
    return score(documents, train(spark, documents, labels, **how))
