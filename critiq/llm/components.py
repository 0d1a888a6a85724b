"""Connected components of a link table, on Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.llm.common import staged

#: Links that one task contracts at a time.
BLOCK = 1_000_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block of links becomes stars: every node linked to its block's smallest
    node that it reaches. Connectivity stays; a block of m nodes keeps under m links."""

    def stars(blocks: list[pa.RecordBatch]) -> pa.RecordBatch:
        a = np.concatenate([np.asarray(b.column(0)) for b in blocks])
        b = np.concatenate([np.asarray(b.column(1)) for b in blocks])
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = at[: len(a)], at[len(a) :]
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[x], root[y])
            new = root.copy()
            np.minimum.at(new, root[x], low)
            np.minimum.at(new, root[y], low)
            new = new[new]
            while not np.array_equal(new, new[new]):
                new = new[new]
            if np.array_equal(new, root):
                break
            root = new
        far = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[root[far]])], ["v", "u"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK:
            yield stars(held)
            held, rows = [], 0
    if rows:
        yield stars(held)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (two long columns, any names):
    component is the smallest node reachable. Nodes without links have no row;
    nulls link nothing.

    Links shrink to stars inside each task first. Then rounds of the large-star and
    small-star steps: a node hands its larger neighbours, then its smaller ones, to
    its smallest neighbour, until every component is a star; about log of the longest path
    many. Each round's links are a table in the shared folder. A node's smallest
    neighbour is a partial aggregate, and the join that hands it on is one whose
    hot keys AQE splits.
    """
    a, b = links.columns
    edges = (
        links.select(F.col(a).cast("long").alias("v"), F.col(b).cast("long").alias("u"))
        .where("v is not null and u is not null and v != u")
        .mapInArrow(_contracted, "v long, u long")
        .distinct()
    )
    edges = staged(spark, edges, "links")  # v > u throughout
    while not _loose(edges).isEmpty():
        both = edges.unionByName(edges.selectExpr("u as v", "v as u"))
        least = both.groupBy(F.col("v").alias("n")).agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = (
            both.where("u > v").join(least, F.col("v") == F.col("n")).selectExpr("u as v", "m as u")
        ).where("v != u").distinct()
        # every node's links now go to smaller nodes; each keeps them by way of the smallest
        least = large.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m"))
        small = large.join(least, F.col("v") == F.col("n")).select(
            F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")
        )
        edges = staged(spark, small.select("e.*").where("v != u").distinct(), "links")
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)


def _loose(edges: DataFrame) -> DataFrame:
    """Nodes linked to several smaller ones, or to one that is itself linked to a smaller one. If there
    are none, every component is a star around its smallest node."""
    several = edges.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").select("v")
    inner = edges.select(F.col("v").alias("w")).distinct()
    return several.union(edges.join(inner, F.col("u") == F.col("w"), "left_semi").select("v"))
