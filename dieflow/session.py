"""Session defaults and the shared checkpoint folder."""
from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "dieflow", **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the one the session names, else one in its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


# The folders of the innermost scope of this thread: loads that run side by side do not see each other's.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a table this library writes and reads again."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (made := _scope.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Folders made inside are deleted at the end; nothing lazy that reads them may leave the block."""
    made: list[str] = []
    outer = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage: a table in the shared folder, read back by column.

    Survives lost executors, fixes values such as generated ids, and its file size lets
    the planner choose joins.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

