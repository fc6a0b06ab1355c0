"""Wafer maps from part results."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wafer_extent(parts: DataFrame) -> DataFrame:
    """Per file: lowest and highest x and y, both counted from 0, and the ranges."""
    zero = F.lit(0)
    extent = parts.groupBy("path").agg(
        F.least(F.min("x_coord"), zero).alias("x_min"), F.greatest(F.max("x_coord"), zero).alias("x_max"),
        F.least(F.min("y_coord"), zero).alias("y_min"), F.greatest(F.max("y_coord"), zero).alias("y_max"),
    )
    return extent.withColumns(
        {"x_range": F.col("x_max") - F.col("x_min") + 1, "y_range": F.col("y_max") - F.col("y_min") + 1}
    )


def wafer_map(parts: DataFrame) -> DataFrame:
    """Last hard and soft bin at each position; reduced per task before the shuffle."""
    last = F.max(F.struct("record_index", "hard_bin", "soft_bin"))
    cells = parts.groupBy("path", "x_coord", "y_coord").agg(last.alias("p"))
    return cells.select("path", "x_coord", "y_coord", F.col("p.hard_bin").alias("hard_bin"), F.col("p.soft_bin").alias("soft_bin"))


def wafer_grid(cells: DataFrame, x_values: list[int], bin_column: str = "hard_bin") -> DataFrame:
    """One row per y with a column per x; empty positions are bin 0."""
    return cells.groupBy("path", "y_coord").pivot("x_coord", x_values).agg(F.first(bin_column)).fillna(0)
