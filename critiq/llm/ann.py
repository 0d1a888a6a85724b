"""Approximate nearest neighbours by adaptive dimension scan.

Nearness is the largest inner product. Each vector gets one more coordinate that
brings it to the largest norm M of the table, queries get a zero there: then the squared
distance is M^2 + |q|^2 - 2 <q, x>, and the nearest by distance are the largest by product. The vectors are turned by a
random rotation, which spreads every difference evenly over the coordinates, and kept in
blocks of columns. Lists are the cells of centroids fitted on a bounded sample; every
vector is in the list of its nearest centroid.

A query scans the lists it probes block of columns by block. After d of D
coordinates its partial distance, times D / d, estimates the whole; a candidate is
abandoned as soon as that is so far above the limit that the hypothesis "it is
nearer than the limit" fails (limit * (1 + epsilon / sqrt(d))^2). The limit is the k-th best
distance among the sample's rows in the lists that the query probes, a bound on the final one there. Survivors get
their exact product, in double precision on the original vectors. All results come out of the lists: the sample is
only used for centroids, limits and the number of lists.

How many lists a query probes is measured on the sample: the fewest that hold
``target_recall`` of its true neighbours there. The sample is thinner than the table, so its
neighbours are farther and the number is, if anything, too large. A query whose lists hold fewer than k candidates
probes on, nearest list first, until they do. One that the tests leave with fewer than there are
is searched again without them.

Defined cases: vectors that are null, zero, hold a null or non-finite component, or have another
dimension than most vectors (of two equally frequent ones, the larger) take no part,
neither do rows without vec_id; of rows that share a vec_id the smallest vector stands; ties go to the
smaller vec_id; fewer than k candidates are all returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from critiq.llm.common import staged

K = 20
MAX_LISTS = 4096
#: Rows of the sample for each list, and the most numbers it may hold.
SAMPLE_PER_LIST, SAMPLE_NUMBERS = 32, 1 << 23
TARGET_RECALL = 0.97
EPSILON = 2.1
BLOCK_COLUMNS = 16
CHUNK_ROWS, CHUNK_QUERIES = 4096, 2048
#: Queries whose distances to a chunk are worked out together.
QUERY_ROWS = 64
SEED = 5

RESULT = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Index:
    vectors: DataFrame  # vec_id, embedding, list, place
    rotation: np.ndarray
    centroids: np.ndarray  # rotated
    sample: np.ndarray  # vectors of the sample, original
    sample_ids: np.ndarray
    sample_lists: np.ndarray
    norm: float
    probes: int
    sizes: np.ndarray  # rows of each list


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part, one for each vec_id."""
    whole = "embedding is not null and vec_id is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    return (
        embeddings.selectExpr("cast(vec_id as long) as vec_id", "cast(embedding as array<double>) as embedding")
        .where(f"{whole} and exists(embedding, x -> x != 0)")
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column, all of length ``dim``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dim)


def augmented(vectors: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0, norm**2 - (vectors**2).sum(axis=1)))
    return np.hstack([vectors, rest[:, None]])


def centroid_distances(rotated: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances but for each row's own norm."""
    return (centroids**2).sum(axis=1) - 2 * rotated @ centroids.T


def fit_centroids(points: np.ndarray, n_lists: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centroids = points[np.sort(rng.choice(len(points), n_lists, replace=False))]
    for _ in range(rounds):
        own = centroid_distances(points, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=n_lists)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(1, n)[:, None], centroids)
    return centroids


def build(spark: SparkSession, embeddings: DataFrame, k: int = K, target_recall: float = TARGET_RECALL) -> Index | None:
    """The index of all usable rows, written to the shared folder; None if there are none."""
    rows = staged(spark, usable(embeddings), "vectors")
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.expr("aggregate(embedding, 0d, (a, x) -> a + x * x)")).alias("square")
    )
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return None
    dim, n, norm = most["d"], most["n"], float(np.sqrt(most["square"]))
    rows = rows.where(F.size("embedding") == dim)
    n_lists = int(min(MAX_LISTS, max(1, round(n**0.5)), max(1, SAMPLE_NUMBERS // (SAMPLE_PER_LIST * dim))))
    bound = max(n_lists, min(SAMPLE_PER_LIST * n_lists, SAMPLE_NUMBERS // dim))
    table = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(bound).toArrow()
    sample, ids = matrix(table["embedding"], dim), np.asarray(table["vec_id"])
    rotation = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim + 1, dim + 1)))[0]
    turned = augmented(sample, norm) @ rotation
    centroids = fit_centroids(turned, min(n_lists, len(sample)))
    sample_lists = centroid_distances(turned, centroids).argmin(axis=1)
    probes = _probes(sample, sample_lists, centroids, rotation, k, target_recall)

    def assign(batches):
        for batch in batches:
            own = centroid_distances(augmented(matrix(batch.column(1), dim), norm) @ rotation, centroids).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], ["vec_id", "embedding", "list"])

    listed = staged(spark, rows.mapInArrow(assign, "vec_id long, embedding array<double>, list int"), "lists")
    # a row's place: lists end to end, rows of a list spread over its length by hash
    counts = listed.groupBy("list").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(W.orderBy("list").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col("list").alias("l"), "rows", before.alias("before"))
    place = F.col("before") + F.pmod(F.xxhash64("vec_id"), F.col("rows"))
    vectors = listed.join(counts, F.col("list") == F.col("l")).select("vec_id", "embedding", "list", place.alias("place"))
    sizes = np.zeros(len(centroids), np.int64)
    for r in listed.groupBy("list").count().collect():  # one row for each list
        sizes[r["list"]] = r["count"]
    return Index(vectors, rotation, centroids, sample, ids, sample_lists, norm, probes, sizes)


def _probes(sample, own, centroids, rotation, k, target) -> int:
    """The fewest lists in which queries out of the sample find ``target`` of their k nearest of it."""
    k = min(k, len(sample) - 1)
    if not k:
        return 1
    asked = np.arange(min(256, len(sample)))
    products = sample[asked] @ sample.T
    products[asked, asked] = -np.inf
    best = np.argpartition(-products, k - 1, axis=1)[:, :k]
    queries = np.hstack([sample[asked], np.zeros((len(asked), 1))]) @ rotation
    rank = centroid_distances(queries, centroids).argsort(axis=1).argsort(axis=1)
    needed = np.sort(np.take_along_axis(rank, own[best], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))))]) + 1


def scan(queries: np.ndarray, blocks: list[np.ndarray], alive: np.ndarray, limits: np.ndarray, epsilon: float) -> np.ndarray:
    """Which pairs of a query (rotated rows) and a candidate no test abandoned; ``alive`` says which to look at.

    ``blocks`` are the candidates' rotated columns. A block of columns is one matrix product for all queries;
    candidates that every query has abandoned, and queries that have abandoned every candidate, leave the
    matrices before the next.
    """
    dim, d = queries.shape[1], 0
    rows, columns = np.arange(alive.shape[0]), np.arange(alive.shape[1])
    out = np.zeros(alive.shape, bool)
    partial = np.zeros(alive.shape, np.float32)
    for block in blocks:
        rows_left, columns_left = alive.any(axis=1), alive.any(axis=0)
        if not (rows_left.all() and columns_left.all()):
            rows, columns = rows[rows_left], columns[columns_left]
            alive, partial = alive[np.ix_(rows_left, columns_left)], partial[np.ix_(rows_left, columns_left)]
        if not len(rows):
            return out
        own, some = queries[rows, d : d + block.shape[1]], block[columns]
        apart = (own**2).sum(axis=1)[:, None] + (some**2).sum(axis=1) - 2 * (own @ some.T)
        partial += np.maximum(apart, 0)
        d += block.shape[1]
        factor = d / dim * (1 + epsilon / np.sqrt(d)) ** 2 if d < dim else 1.0
        alive = alive & (partial <= (limits[rows] * (factor * (1 + 1e-5)) + 1e-5)[:, None])
    out[np.ix_(rows, columns)] = alive
    return out


def probed(apart: np.ndarray, sizes: np.ndarray, probes: int, k: int) -> np.ndarray:
    """For each query (rows of distances to centroids) the lists it probes, as flags: the ``probes`` nearest
    that hold rows, and on until they hold more than ``k``."""
    apart = np.where(sizes > 0, apart, np.inf)
    order = apart.argsort(axis=1, kind="stable")
    held = np.cumsum(sizes[order], axis=1)
    enough = (held > k).argmax(axis=1) + 1
    enough[held[:, -1] <= k] = len(sizes)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(sizes))[None, :], axis=1)
    return (rank < np.maximum(enough, probes)[:, None]) & (sizes > 0)


def search(spark: SparkSession, index: Index | None, queries: DataFrame, k: int = K, epsilon: float = EPSILON) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each of ``queries`` (query_id, embedding),
    but for the row of that vec_id itself."""
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, most = len(index.rotation) - 1, int(min(k, index.sizes.sum() - 1))
    asked = queries.select("query_id", "embedding").where(F.size("embedding") == dim)
    found = staged(spark, _scanned(spark, index, asked, k, epsilon), "neighbours")
    counts = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("found"))
    few = asked.join(counts, "query_id", "left").where(F.coalesce("found", F.lit(0)) < most).select("query_id", "embedding")
    few = staged(spark, few, "open-queries")
    if not few.isEmpty():  # tests that went wrong; all distances are worked out
        found = found.unionByName(_scanned(spark, index, few, k, None)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _scanned(spark: SparkSession, index: Index, asked: DataFrame, k: int, epsilon: float | None) -> DataFrame:
    """``RESULT``: at most k rows for each query and chunk. Without ``epsilon`` there is no limit.

    Vectors lie in chunks of about CHUNK_ROWS, several lists or part of one. A query goes once to each chunk
    that has rows of a list it probes; the chunk is loaded once and goes through its queries in blocks. A chunk with more
    than CHUNK_QUERIES queries is copied, once for each part of them, and no other one is: what is sent is
    in proportion to the queries and the lists they probe.
    """
    dim, rotation, centroids, sizes, norm = len(index.rotation) - 1, index.rotation, index.centroids, index.sizes, index.norm
    probes, n_chunks = index.probes, -(-int(sizes.sum()) // CHUNK_ROWS)
    last = np.cumsum(sizes)  # lists lie end to end
    first = (last - sizes) // CHUNK_ROWS
    last = np.maximum(last - 1, 0) // CHUNK_ROWS
    sample = spark.sparkContext.broadcast((index.sample, index.sample_ids, index.sample_lists))

    def probe(batches):
        points, ids, lists = sample.value
        for batch in batches:
            own, vectors = np.asarray(batch.column(0)), matrix(batch.column(1), dim)
            rows, worst, chunks = [], [], []
            for i in range(0, len(own), QUERY_ROWS):  # bounded: so many queries by the sample
                q, name = vectors[i : i + QUERY_ROWS], own[i : i + QUERY_ROWS]
                hit = probed(centroid_distances(np.hstack([q, np.zeros((len(q), 1))]) @ rotation, centroids), sizes, probes, k)
                products = q @ points.T
                products[(name[:, None] == ids) | ~hit[:, lists]] = -np.inf
                least = np.partition(products, -k, axis=1)[:, -k] if products.shape[1] >= k else np.full(len(q), -np.inf)
                for j in range(len(q)):
                    edges = np.zeros(n_chunks + 1, np.int64)
                    np.add.at(edges, first[hit[j]], 1)
                    np.add.at(edges, last[hit[j]] + 1, -1)
                    some = np.flatnonzero(np.cumsum(edges)[:n_chunks])
                    rows.append(np.full(len(some), i + j))
                    worst.append(np.full(len(some), least[j] if epsilon is not None else -np.inf))
                    chunks.append(some)
            pick = pa.array(np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64))
            columns = [batch.column(0).take(pick), batch.column(1).take(pick), pa.array(np.concatenate([*worst, np.empty(0)]))]
            columns.append(pa.array(np.concatenate([*chunks, np.empty(0, np.int64)]).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "embedding", "worst", "chunk"])

    asked = staged(spark, asked.mapInArrow(probe, "query_id long, embedding array<double>, worst double, chunk long"), "probes")
    parts = asked.groupBy("chunk").agg(F.ceil(F.count("*") / CHUNK_QUERIES).cast("long").alias("parts"))
    parts = staged(spark, parts, "chunk-parts").withColumnRenamed("chunk", "c")
    asked = asked.join(parts, F.col("chunk") == F.col("c")).withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")))
    stored = index.vectors.withColumn("chunk", F.floor(F.col("place") / CHUNK_ROWS)).join(parts, F.col("chunk") == F.col("c"))
    stored = stored.withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [], [], []
        if left.num_rows and right.num_rows:
            left = left.sort_by("vec_id")
            ids, own = np.asarray(left["vec_id"]), np.asarray(left["list"])
            vectors = matrix(left["embedding"], dim)
            turned = (augmented(vectors, norm) @ rotation).astype(np.float32)
            blocks = [np.ascontiguousarray(turned[:, c : c + BLOCK_COLUMNS]) for c in range(0, dim + 1, BLOCK_COLUMNS)]
            asked = matrix(right["embedding"], dim)
            rotated = np.hstack([asked, np.zeros((len(asked), 1))]) @ rotation
            names, worst = np.asarray(right["query_id"]), np.asarray(right["worst"])
            limits = norm**2 + (asked**2).sum(axis=1) - 2 * worst  # infinite without k rows in the sample
            for i in range(0, len(asked), QUERY_ROWS):
                part = slice(i, i + QUERY_ROWS)
                alive = probed(centroid_distances(rotated[part], centroids), sizes, probes, k)[:, own] & (names[part, None] != ids)
                if epsilon is not None:
                    alive = scan(rotated[part].astype(np.float32), blocks, alive, limits[part], epsilon)
                for j, rows in enumerate(map(np.flatnonzero, alive), i):
                    score = (vectors[rows] * asked[j]).sum(axis=1)
                    best = np.lexsort((ids[rows], -score))[:k]
                    for column, value in zip(out, (np.full(len(best), names[j]), ids[rows][best], score[best]), strict=True):
                        column.append(value)
        columns = [np.concatenate([*c, np.empty(0, t)]).astype(t) for c, t in zip(out, (np.int64, np.int64, float), strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return (
        stored.select("chunk", "part", "vec_id", "list", "embedding")
        .groupBy("chunk", "part")
        .cogroup(asked.select("chunk", "part", "query_id", "embedding", "worst").groupBy("chunk", "part"))
        .applyInArrow(near, RESULT)
    )


def nearest(spark: SparkSession, embeddings: DataFrame, every: int = 20, k: int = K, **how) -> DataFrame:
    """Search with every row whose vec_id is divisible by ``every`` as a query."""
    index = build(spark, embeddings, k, **how)
    if index is None:
        return search(spark, None, embeddings, k)
    asked = index.vectors.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    return search(spark, index, asked, k)
