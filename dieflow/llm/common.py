"""Small helpers shared by the operators of this package."""
from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dieflow.session import scratch_path


# Bits of a filter over 64-bit keys: 2 MB, however many keys there are.
FILTER_BITS = 24
# Rows sent to Python at once while an intermediate table is written.
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


class Scratch:
    """Intermediate tables of one operator call, in the shared checkpoint folder.

    ``keep`` writes a table and reads it back: lineage ends there, so a lost executor
    cannot change values or start everything over. ``drop`` removes what is no longer read.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.paths = spark, scratch_path(spark, name), {}

    def path(self, name: str) -> str:
        return f"{self.base}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with _small_batches(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            _, path = self.paths.pop(id(df), (None, None))
            if path:
                delete(self.spark, path)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Plans made meanwhile send at most BATCH_ROWS rows at once; the session's own setting comes back."""
    before = spark.conf.get(BATCH)
    rows = int(before)
    spark.conf.set(BATCH, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def give_back() -> None:
    """Return a Python worker's free memory to the system: workers stay for later tasks and stages."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's own file system layer."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_filter(keys: DataFrame, column: str) -> Broadcast:
    """A bit map of fixed size over a column of well-spread 64-bit keys, built by Spark and sent to every task."""
    low = F.pmod(F.col(column), F.lit(1 << FILTER_BITS))
    parts = keys.groupBy(F.shiftright(low, 15).alias("part")).agg(F.bitmap_construct_agg(low.bitwiseAND(F.lit(32767))).alias("bits")).collect()
    bits = bytearray(1 << FILTER_BITS - 3)
    for part, found in parts:
        bits[part * 4096:part * 4096 + 4096] = found
    return keys.sparkSession.sparkContext.broadcast(bytes(bits))


def maybe_in(shared: Broadcast, column: str) -> Column:
    """Whether a key may be among those of the filter; never false for one that is."""

    def known(key: pd.Series) -> pd.Series:
        at = key.to_numpy() & ((1 << FILTER_BITS) - 1)
        return pd.Series(np.frombuffer(shared.value, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1)

    return F.pandas_udf(known, "boolean")(column)


def narrowed(rows: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows that may have one of the keys, to be joined exactly, and rows that have none."""
    marked = rows.withColumn("_known", maybe_in(key_filter(keys, column), column))
    return marked.filter("_known").drop("_known"), marked.filter("not _known").drop("_known")


def without(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key is not among ``keys``; only rows that pass the filter are shuffled."""
    some, rest = narrowed(rows, keys, column)
    return rest.unionByName(some.join(keys, column, "left_anti"))
