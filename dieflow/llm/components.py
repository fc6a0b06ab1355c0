"""Connected components of a table of links, by alternating star contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dieflow.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, component) for every vertex of ``links(a, b)``; a component is named by its smallest vertex.

    Links from a vertex to itself, repeated links and NULLs are ignored. A round hangs every
    vertex's larger neighbours, then its smaller ones, under the smallest vertex it sees;
    rounds end when no link changes (a number of rounds logarithmic in practice). Minima
    are aggregated before the shuffle and joined back, so a hub's links stay spread.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("w")).filter(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    )
    edges, mark = scratch.keep(edges.distinct(), "links"), None
    while (now := _mark(edges)) != mark:
        mark = now
        both = edges.unionByName(edges.select(F.col("w").alias("u"), F.col("u").alias("w")))
        lowest = both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("w > u").join(lowest, "u").select(F.col("w").alias("u"), F.col("m").alias("w")).distinct()
        root = large.groupBy("u").agg(F.min("w").alias("m"))
        small = large.join(root, "u").filter("w != m").select(F.col("w").alias("u"), F.col("m").alias("w"))
        previous, edges = edges, scratch.keep(small.unionByName(root.withColumnRenamed("m", "w")).distinct(), "links")
        scratch.drop(previous)
    roots = edges.select(F.col("w").alias("v"), F.col("w").alias("component")).distinct()
    return edges.select(F.col("u").alias("v"), F.col("w").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "w").cast("decimal(38,0)"))).first())
