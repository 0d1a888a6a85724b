"""Mixing sources to target weights by hash-threshold histograms.

A mix takes ``budget`` times all words. Each source's target is its share of
that by weight, at most ``max_epochs`` times its own size; what is cut off goes to
the others by weight until nobody is above. A source whose target is T of its
size S is taken whole floor(T / S) times, and the remaining words come from the
documents whose hash lies below a threshold. The threshold is found without sorting:
sum words by source and hash bucket, find the bucket in which the budget ends, split
only that bucket finer, and so on until it holds one hash value. Thresholds nest:
a smaller budget's mix is part of a larger one's.

Whole documents are taken, so a source ends within half of its boundary
document's size of its target. The hash is md5 of a salt and the doc_id, so
reruns, retries and other engines agree.

Defined cases: null and empty texts have size 0 and are never taken (0 words);
null is a source of its own, the last; rows that share a doc_id share a hash and
count as one document of their summed size, taken or left together; a null doc_id hashes as the empty text; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from critiq.llm.common import WORD_PATTERN, n_words, staged

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
SALT = "mix:"
#: Bits of the hash, and bits by which a level splits a bucket.
HASH_BITS, LEVEL_BITS = 60, 10


def doc_hash(doc_id: F.Column, salt: str = SALT) -> F.Column:
    text = F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget=BUDGET, max_epochs=MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from (source, size), one row a source.

    Resharing until no source is above its cap ends at one level: sources in
    order of cap to weight are capped as long as the words left for the rest,
    shared by weight, still exceed their cap.  One row for each source goes through the
    single-partition windows here, never one for each document.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    everything = W.partitionBy()
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("w", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
        .withColumn("words", F.sum("source_size").over(everything) * F.lit(float(budget)))
    )
    by_ratio = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, W.unboundedFollowing)
    level = (F.col("words") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    leveled = ranked.withColumn("level", level)
    # the first source in that order whose share stays within its cap sets the level; levels fall from there on
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    return leveled.withColumn("final", F.max(fits).over(everything)).select(
        "source",
        "source_size",
        F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("final") * F.col("w"))).alias("target"),
    )


def thresholds(spark: SparkSession, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, source_size, target, epochs, below`` (sources null-safe): documents with
    hash < below are taken once more than ``epochs`` times.

    Each level sums the words of the boundary bucket of each source into
    2**LEVEL_BITS finer ones; at the first level the boundary bucket is everything.
    Levels stop once every boundary bucket holds one hash value.
    """
    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0))
    state = staged(
        spark,
        targets.withColumn("epochs", whole.cast("long"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("low", F.lit(0).cast("long"))  # the boundary bucket's number at this level
        .withColumn("taken", F.lit(0).cast("long")),  # words below it
        "mix-state",
    )
    for bits in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        bucket = F.shiftright("h", bits)
        at = state.select(F.col("source").alias("s"), F.col("low").alias("l"), "rest", F.col("taken").alias("t"))
        inside = (F.col("source").eqNullSafe(F.col("s"))) & (F.shiftright("h", bits + LEVEL_BITS) == F.col("l"))
        bins = (
            sized.withColumn("bucket", bucket)
            .join(at, inside)
            .groupBy("source", "bucket", "rest", "t")
            .agg(F.sum("size").alias("words"), F.min("h").alias("h0"), F.max("h").alias("h1"))
        )
        # at most 2**LEVEL_BITS bins a source
        run = W.partitionBy("source").orderBy("bucket")
        bins = bins.withColumn("upto", F.col("t") + F.sum("words").over(run))
        edge = (
            bins.where("rest > 0 and upto > rest")
            .groupBy(F.col("source").alias("s"))
            .agg(F.min(F.struct("bucket", "upto", "words", "h0", "h1")).alias("e"))
        )
        state = staged(
            spark,
            state.drop("h0", "h1", "edge_words")
            .join(edge, F.col("source").eqNullSafe(F.col("s")), "left")
            .select(
                "source", "source_size", "target", "epochs", "rest",
                F.coalesce("e.bucket", F.lit(-1)).cast("long").alias("low"),
                F.when(F.col("e").isNull(), F.col("taken")).otherwise(F.col("e.upto") - F.col("e.words")).alias("taken"),
                F.col("e.words").alias("edge_words"),
                F.col("e.h0").alias("h0"),
                F.col("e.h1").alias("h1"),
            ),
            "mix-state",
        )
        if state.where("h0 != h1").isEmpty():
            break
    # the boundary document goes in if that brings the source nearer to its target
    nearer = (F.col("taken") + F.col("edge_words") - F.col("rest")) < (F.col("rest") - F.col("taken"))
    below = F.when(F.col("h0").isNull(), F.when(F.col("rest") > 0, F.lit(1 << HASH_BITS)).otherwise(F.lit(0)))
    below = below.otherwise(F.when(nearer, F.col("h0") + 1).otherwise(F.col("h0")))
    return state.select("source", "source_size", "target", "epochs", below.cast("long").alias("below"))


def mix(spark: SparkSession, documents: DataFrame, **how) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of
    ``documents`` (doc_id, text, source); ``copies`` times the document is in the mix.

    Texts are read once, for their size; the levels read a narrow table (source,
    hash, size). Words are summed before the shuffle, so a source with a third of
    all rows sends a task's 1024 sums, not its rows. The per-source table joins by
    broadcast as far as its measured size allows.
    """
    sized = staged(
        spark,
        documents.select(
            "doc_id", "source", n_words(F.col("text")).alias("size"), doc_hash(F.col("doc_id")).alias("h")
        ),
        "mix-sizes",
    )
    cuts = thresholds(spark, sized, source_targets(sized, **how))
    cuts = cuts.withColumnRenamed("source", "s")
    joined = sized.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
    copies = F.col("epochs") + (F.col("h") < F.col("below")).cast("long")
    return joined.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(spark: SparkSession, documents: DataFrame, **how) -> DataFrame:
    """The mix itself: each row of ``documents``, all columns, ``copies`` times.

    Nothing is joined by document: a row's hash and its source's threshold decide, and there
    is one threshold for each source.
    """
    sized = staged(
        spark,
        documents.select("source", n_words(F.col("text")).alias("size"), doc_hash(F.col("doc_id")).alias("h")),
        "mix-sizes",
    )
    cuts = thresholds(spark, sized, source_targets(sized, **how))
    cuts = cuts.select(F.col("source").alias("_mix_source"), "epochs", "below")
    cuts = cuts.withColumnsRenamed({"epochs": "_mix_epochs", "below": "_mix_below"})
    copies = F.col("_mix_epochs") + (doc_hash(documents["doc_id"]) < F.col("_mix_below")).cast("long")
    copies = F.when(F.col("text").rlike(WORD_PATTERN), copies).otherwise(F.lit(0))  # without a word there is nothing to take
    joined = documents.join(cuts, documents["source"].eqNullSafe(F.col("_mix_source")), "left")
    repeated = joined.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.greatest(copies.cast("int"), F.lit(1)))))
    return repeated.where(copies >= F.col("_mix_copy")).select(*documents.columns)
