"""Counts and distributions over records, measurements and loads."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dieflow.functions.text import non_empty
from dieflow.sources.registry import DEFAULT_TYPES

TOTAL = "TOTAL"


def record_stats(records: DataFrame) -> DataFrame:
    """Records by file and type, with a TOTAL row per file and one overall.

    Counts are reduced to one row per (file, type) first, so the rollup expands those only.
    """
    counts = records.groupBy("path", "record_type").agg(F.count("*").alias("_n"))
    rolled = counts.rollup("path", "record_type").agg(F.sum("_n").alias("n_records"), F.grouping_id().alias("_level"))
    return rolled.select(
        F.when(F.col("_level") < 3, F.col("path")).otherwise(TOTAL).alias("path"),
        F.when(F.col("_level") == 0, F.col("record_type")).otherwise(TOTAL).alias("record_type"),
        "n_records",
    )


def parse_counts(records: DataFrame, types: tuple[str, ...] = DEFAULT_TYPES) -> DataFrame:
    """Per file: all records and those of the enabled types."""
    return records.groupBy("path").agg(
        F.count("*").alias("total_records"), F.count_if(F.col("record_type").isin(*types)).alias("parsed_records")
    )


def distinct_entities(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Number of distinct non-empty values of each column, one row per column.

    Exact counting reduces each (column, value) pair per task before the shuffle.
    """
    if approximate:
        counts = df.agg(*[F.approx_count_distinct(non_empty(F.col(c).cast("string"))).alias(c) for c in columns])
        return counts.select(F.explode(F.create_map(*[v for c in columns for v in (F.lit(c), F.col(c))])).alias("entity", "n_distinct"))
    pairs = df.select(F.explode(F.create_map(*[v for c in columns for v in (F.lit(c), F.col(c).cast("string"))])).alias("entity", "value"))
    values = pairs.filter(non_empty(F.col("value")).isNotNull()).distinct()
    return values.groupBy("entity").agg(F.count("*").alias("n_distinct"))


def _n_rows(rows: str | None, condition: Column | None = None) -> Column:
    """Number of rows, each one or what its column ``rows`` says, that meet a condition."""
    if rows is None:
        return F.count("*") if condition is None else F.count_if(condition)
    return F.coalesce(F.sum(rows if condition is None else F.when(condition, F.col(rows))), F.lit(0).cast("bigint"))


def measurement_stats(measurements: DataFrame, rows: str | None = None) -> DataFrame:
    """One row: total and per test type; ``rows`` names a column with the measurements that a row stands for."""
    of = F.col("record_type")
    return measurements.agg(
        _n_rows(rows).alias("total"),
        _n_rows(rows, of == "PTR").alias("ptr"),
        _n_rows(rows, of == "MPR").alias("mpr"),
        _n_rows(rows, of == "FTR").alias("ftr"),
    )


def flag_distribution(measurements: DataFrame, rows: str | None = None) -> DataFrame:
    """Measurements by raw test flag; ``rows`` as in ``measurement_stats``."""
    return measurements.groupBy("test_flg").agg(_n_rows(rows).alias("n"))


def id_distribution(
    df: DataFrame, column: str, n: int | None = None, first_rows: int | None = None, order: list[str] | None = None, rows: str | None = None,
) -> DataFrame:
    """Rows and percent per id, most frequent first; optionally top n, or on the first rows of an order only; ``rows`` as in ``measurement_stats``."""
    source = df.orderBy(*order).limit(first_rows) if first_rows else df
    counts = source.groupBy(column).agg(_n_rows(rows).alias("n"))
    # One row, so the broadcast is bounded.
    total = counts.agg(F.sum("n").alias("_total"))
    rated = counts.crossJoin(F.broadcast(total)).select(column, "n", (F.col("n") * 100.0 / F.col("_total")).alias("percent"))
    return rated.orderBy(F.desc("n"), column).limit(n) if n else rated


def bin_distribution(parts: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent hard and soft bins with parts tested; empty bins are ignored."""
    bins = F.create_map(F.lit("hard"), F.col("hard_bin").cast("string"), F.lit("soft"), F.col("soft_bin").cast("string"))
    counts = (
        parts.select(F.explode(bins).alias("kind", "bin"))
        .filter(non_empty(F.col("bin")).isNotNull())
        .groupBy("kind", "bin").agg(F.count("*").alias("n"))
    )
    # Bins are 16-bit numbers, so the counts ranked here are few.
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "bin"))
    top = counts.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    tested = parts.agg(F.count("*").alias("parts_tested"))
    return top.crossJoin(F.broadcast(tested))


# Device attributes kept from a device's first measurement.
DEVICE_INFO = [
    "wld_device_dmc", "wld_phoenix_id", "wld_latest", "wld_bin_code", "wld_bin_desc", "wfi_facility", "wfi_operation",
    "wl_lot_name", "wmp_prog_name", "wmp_prog_version", "wfi_equipment", "sft_name", "sft_group", "wld_created_date",
]


def device_info(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Attributes of each device from its first row in ``order``; missing ones are empty.

    ``rows`` may be one row per device and file: every measurement of those is equal in
    these columns, so the product need not be built.
    """
    kept = [c for c in DEVICE_INFO if c in rows.columns]
    first = rows.groupBy("wld_id").agg(F.min_by(F.struct(*kept), F.struct(*order)).alias("d"))
    return first.select(
        "wld_id", *[(F.coalesce(F.col(f"d.{c}"), F.lit("")) if c in kept else F.lit("")).alias(c) for c in DEVICE_INFO]
    )


def multi_value_ratio(tests: DataFrame) -> DataFrame:
    """One row: tests with several values, with one, and the percent of the former."""
    several = F.count_if(F.size("values") > 1)
    return tests.agg(
        several.alias("multi_value"),
        F.count_if(F.size("values") <= 1).alias("single_value"),
        F.coalesce(several * 100.0 / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("percent_multi"),
    )


def per_device_counts(devices: DataFrame, tests: DataFrame) -> DataFrame:
    """Measurements of each device of a file, and their mean per test.

    Every device meets every test of its file, so the counts come from the file's
    totals and the product is never built.
    """
    totals = tests.groupBy("path").agg(F.count("*").alias("_tests"), F.sum(F.size("values")).alias("_values"))
    return devices.join(totals, "path", "left").select(
        "path", "device_index", "wld_device_dmc",
        F.coalesce("_values", F.lit(0)).cast("bigint").alias("n_measurements"),
        F.coalesce(F.col("_values") / F.nullif(F.col("_tests"), F.lit(0)), F.lit(0.0)).alias("avg_per_test"),
    )


def partition_counts(measurements: DataFrame, key: str = "wld_id", rows: str | None = None) -> DataFrame:
    """Rows per device partition; ``rows`` as in ``measurement_stats``."""
    return measurements.groupBy(key).agg(_n_rows(rows).alias("n_rows"))


def load_summary(log: DataFrame) -> DataFrame:
    """Per status: files, measurements, elapsed seconds, rows per second and seconds per file."""
    return log.groupBy("status").agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("measurements"), F.lit(0)).alias("measurements"),
        F.coalesce(F.sum("elapsed"), F.lit(0.0)).alias("elapsed"),
        F.coalesce(F.sum("measurements") / F.nullif(F.sum("elapsed"), F.lit(0.0)), F.lit(0.0)).alias("rows_per_second"),
        F.coalesce(F.avg("elapsed"), F.lit(0.0)).alias("seconds_per_file"),
    )


def order_by_count(records: DataFrame, column: str = "record_type") -> DataFrame:
    """Groups by falling count."""
    return records.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most common values."""
    return order_by_count(df, column).limit(k)


def first_k(df: DataFrame, k: int, order: list[str | Column]) -> DataFrame:
    """First k rows of an order."""
    return df.orderBy(*order).limit(k)


def union_entities(*sources: DataFrame) -> DataFrame:
    """Distinct values of one-column frames."""
    out = sources[0]
    for other in sources[1:]:
        out = out.union(other)
    return out.distinct()


def field_set_ops(left: DataFrame, right: DataFrame) -> DataFrame:
    """Names common to both sides, only on the left, only on the right: (name, side)."""
    name = left.columns[0]
    flagged = left.select(name, F.lit(True).alias("_l"), F.lit(False).alias("_r")).union(right.select(F.col(right.columns[0]), F.lit(False), F.lit(True)))
    # One grouped pass instead of an intersection and two differences.
    sides = flagged.groupBy(name).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return sides.select(name, F.when(F.col("_l") & F.col("_r"), "common").when(F.col("_l"), "left").otherwise("right").alias("side"))
