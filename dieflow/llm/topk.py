"""Exact top-k search by selection on distributed score histograms."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dieflow.llm.common import Scratch

# Bins of a histogram per round; rows of a block of candidates and of queries.
BINS = 1024
CANDIDATES, QUERIES = 4096, 512


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale x component) of each component as whole numbers; NULL for vectors that take no part."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~odd, whole)


def _packed(size: int, extra: list[str]):
    """Pack the rows of a task into blocks of ``size``: ids, vectors, and further whole numbers, as bytes."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, group in frame.groupby(frame["vector"].map(len), sort=False):
                for lo in range(0, len(group), size):
                    part = group.iloc[lo:lo + size]
                    matrix = np.stack(part["vector"].to_numpy()).astype("<i8")
                    numbers = part[["vec_id", *extra]].to_numpy().astype("<i8")
                    yield pd.DataFrame({"n": [len(part)], "width": [matrix.shape[1]], "vectors": [matrix.tobytes()], "numbers": [numbers.tobytes()]})

    return pack


PACKED = "n long, width long, vectors binary, numbers binary"


def _blocks(row, extra: int, side: str) -> tuple[np.ndarray, np.ndarray]:
    n = getattr(row, f"n{side}")
    vectors = np.frombuffer(getattr(row, f"vectors{side}"), "<i8").reshape(n, row.width)
    return vectors, np.frombuffer(getattr(row, f"numbers{side}"), "<i8").reshape(n, 1 + extra)


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products, exact: in floating point only where no sum can pass 2^53."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * queries.shape[1]
    if most < 2**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


LEAST = np.iinfo(np.int64).min


def _histograms(k: int):
    """Per query of a block pair: counts of its scores by bin, from the top down to the bin with the block's kth.

    The wanted score of the whole table is at least the kth of any block, so lower bins
    of this block cannot hold it. ``low`` and ``width`` say where the bins lie.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                vectors, known = _blocks(row, 3, "_q")
                others, ids = _blocks(row, 0, "")
                scores = _scores(vectors, others)
                out = []
                for i, (query, low, width, need) in enumerate(known.tolist()):
                    bins = (scores[i][ids[:, 0] != query] - low) // width
                    found, counts = np.unique(bins[(bins >= 0) & (bins < BINS)], return_counts=True)
                    stop = len(found) - np.searchsorted(np.cumsum(counts[::-1]), need) - 1
                    found, counts = found[max(0, stop):], counts[max(0, stop):]
                    out.append(pd.DataFrame({"query_id": query, "bin": found, "n": counts}))
                yield pd.concat(out).astype("int64")

    return count


def _winners():
    """Per query of a block pair: scores above the kth, and of those equal to it the smallest ids still needed."""

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                vectors, known = _blocks(row, 2, "_q")
                others, ids = _blocks(row, 0, "")
                scores, out = _scores(vectors, others), []
                for i, (query, kth, need) in enumerate(known.tolist()):
                    at = np.flatnonzero((scores[i] >= kth) & (ids[:, 0] != query))
                    above, equal = at[scores[i][at] > kth], at[scores[i][at] == kth]
                    equal = equal[np.argsort(ids[equal, 0], kind="stable")[:need]]
                    at = np.r_[above, equal]
                    out.append(pd.DataFrame({"query_id": query, "vec_id": ids[at, 0], "score": scores[i][at]}))
                yield pd.concat(out).astype("int64")

    return keep


def top_k(
    vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """The k best candidates of every query: query_id, rank (from 1), vec_id, score.

    Queries are the rows where ``queries`` holds, candidates every row but the query's own
    (all of them, if fewer than k); the score is the inner product of quantized vectors,
    ties go to the smaller id. Rounds of histograms locate each query's kth largest score:
    a round counts scores in 1024 bins, finds the bin of the kth, and the next round cuts
    that bin into 1024, until a bin is one score wide. Then the scores above it, and the
    smallest ids among those equal to it, are kept.

    Vectors that are NULL or hold a NULL, NaN or infinite component take no part, nor do rows
    with a NULL id; vectors of different lengths are not compared. Rows that share an id are
    each a candidate, and one query by the first of their vectors in order. Without queries
    the result is empty; other columns are not read. Queries meet candidates block by block;
    scores stay inside a task, which passes on at most k counts or k rows a query.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    usable = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), quantized(F.col(vector_column), scale).alias("vector"), queries.alias("is_query"))
    usable = usable.filter("vec_id is not null and vector is not null and size(vector) > 0")
    packs = scratch.keep(usable.select("vec_id", "vector").mapInPandas(_packed(CANDIDATES, []), PACKED).withColumn("part", F.monotonically_increasing_id()), "candidates")
    asked = scratch.keep(usable.filter("is_query").groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
    parts = max(1, min(packs.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    packs = packs.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(parts)))

    def meet(state: DataFrame, extra: list[str]) -> DataFrame:
        """Every block of queries with every block of candidates, dealt by group of candidate blocks."""
        blocks = asked.join(state, "vec_id").mapInPandas(_packed(QUERIES, extra), PACKED)
        blocks = blocks.select(*(F.col(c).alias(c if c == "width" else f"{c}_q") for c in blocks.columns), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part"))
        return packs.join(blocks, ["part", "width"])

    # Bounds of a query's scores from its components and the largest one of any vector.
    biggest = usable.agg(F.max(F.aggregate("vector", F.lit(0).cast("bigint"), lambda m, x: F.greatest(m, F.abs(x))))).first()[0] or 0
    bound = F.aggregate("vector", F.lit(1).cast("bigint"), lambda s, x: s + F.abs(x) * biggest)
    top = asked.select(F.max(bound)).first()[0] or 1
    width, rounds = 1, []
    while width < 2 * top + 1:
        rounds.append(width)
        width *= BINS
    state = asked.select("vec_id", F.lit(-int(top)).cast("bigint").alias("low"), F.lit(k).cast("bigint").alias("need"))
    for width in reversed(rounds):
        pairs = meet(state.withColumn("width_bin", F.lit(width).cast("bigint")).select("vec_id", "low", "width_bin", "need"), ["low", "width_bin", "need"])
        counts = pairs.mapInPandas(_histograms(k), "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        # A query has at most k x candidate blocks of non-empty bins here, and BINS at most.
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        summed = counts.withColumn("upto", F.sum("n").over(down)).join(state.withColumnRenamed("vec_id", "query_id"), "query_id")
        # With fewer than k candidates the lowest bin is taken.
        reached = F.when(F.col("upto") >= F.col("need"), F.struct(F.col("bin"), (F.col("upto") - F.col("n")).alias("above")))
        found = summed.groupBy("query_id").agg(
            F.max(reached).alias("hit"), F.min(F.struct("bin", (F.col("upto") - F.col("n")).alias("above"))).alias("lowest"),
            F.any_value("low").alias("low"), F.any_value("need").alias("need"),
        )
        hit = F.coalesce("hit", "lowest")
        state = scratch.keep(
            found.select(F.col("query_id").alias("vec_id"), (F.col("low") + hit["bin"] * width).alias("low"), (F.col("need") - hit["above"]).alias("need")), "state"
        )
    kept = meet(state, ["low", "need"]).mapInPandas(_winners(), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
