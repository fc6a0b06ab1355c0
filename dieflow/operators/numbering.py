"""Numbering rows inside keys and over whole tables without a hot task.

``row_number`` over a key sorts the whole key in one task. Here a key is cut into
consecutive chunks of its order, rows are numbered inside a chunk, and each chunk
starts after the rows of the chunks before it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dieflow.session import materialize

# Consecutive record numbers that share a chunk.
CHUNK = 1 << 16
# Rows that one task sorts at about, where whole tables are put in order.
SORT_ROWS = 1 << 19


def number_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    weight: Column | None = None,
    chunks: list[Column] | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add ``name``: rows (or ``weight``) before this one in its key, from 0, in ``order``.

    ``order`` is unique within the key and keys are not NULL. ``chunks`` must rise with
    ``order``; the default cuts the first (whole number) order column into ranges.
    ``total`` also adds the key's sum. Input is read twice: once reduced to a row per
    chunk, once for the rows themselves.
    """
    if chunks is None:
        chunks = [F.floor(F.col(order[0]) / CHUNK)]
    cuts = [f"_chunk{i}" for i in range(len(chunks))]
    parts = [*keys, *cuts]
    weight = F.lit(1) if weight is None else weight
    split = df.withColumns({**dict(zip(cuts, chunks)), "_weight": weight.cast("bigint")})
    before = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = split.withColumn("_local", F.coalesce(F.sum("_weight").over(before), F.lit(0)))
    earlier = Window.partitionBy(*keys).orderBy(*cuts).rowsBetween(Window.unboundedPreceding, -1)
    starts = split.groupBy(*parts).agg(F.sum("_weight").alias("_size")).withColumn("_start", F.sum("_size").over(earlier))
    if total:
        starts = starts.withColumn(total, F.sum("_size").over(Window.partitionBy(*keys)))
    else:
        # A key's first chunk starts at 0, so only later chunks are joined.
        starts = starts.filter(F.col("_start").isNotNull())
    joined = local.join(starts.drop("_size"), parts, "left")
    added = [total] if total else []
    return joined.select(*df.columns, (F.col("_local") + F.coalesce("_start", F.lit(0))).alias(name), *added)


def number_in_order(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: ``row_number`` of ``order`` within ``keys``, from 1, for few keys with many rows each.

    A range sort by key and order cuts a key over as many tasks as it needs; each run of a key in a sort
    partition starts after its runs in the partitions before. Keys and order may be NULL or repeat.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    ordered = materialize(
        df.repartitionByRange(max(usual, -(-df.count() // SORT_ROWS)), *keys, *order).sortWithinPartitions(*keys, *order)
        .withColumn("_part", F.shiftrightunsigned(place, 33))
        .withColumn("_local", place.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    runs = ordered.groupBy("_part", *keys).agg(F.count("*").alias("_size"), F.min("_local").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + 1
    starts = runs.select(F.col("_part").alias("_of_part"), *[F.col(k).alias(f"_of_{k}") for k in keys], before.alias("_before"))
    same = [F.col("_part") == F.col("_of_part"), *[F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]]
    # A row per sort partition, and one more where a key begins inside of it, so the broadcast is bounded.
    numbered = ordered.join(F.broadcast(starts), same)
    return numbered.select(*df.columns, (F.col("_local") + F.col("_before")).cast("bigint").alias(name))


def number_all(df: DataFrame, order: list[str], name: str, start: int | Column = 0) -> DataFrame:
    """Add ``name``: dense numbers from ``start`` over the whole table in ``order``.

    A range sort spreads the order over tasks; the sorted rows are kept in the
    checkpoint folder so a lost executor cannot renumber them. The offsets table
    has one row per sort partition, so its broadcast is bounded.
    """
    place = F.monotonically_increasing_id()
    ordered = materialize(
        df.orderBy(*order)
        .withColumn("_part", F.shiftrightunsigned(place, 33))
        .withColumn("_local", place.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    numbered = ordered.join(F.broadcast(offsets), "_part")
    start = F.lit(start) if isinstance(start, int) else start
    return numbered.select(*df.columns, (F.col("_local") + F.col("_start") + start).cast("bigint").alias(name))
