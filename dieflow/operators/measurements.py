"""From devices and tests of a file to measurement rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dieflow.functions.codes import bin_desc, pass_flag
from dieflow.functions.numbers import parse_values, parse_values_strict, safe_float, safe_int
from dieflow.functions.text import (
    clean_param, first_non_empty, is_pixel_test, non_empty, param_source, pixel_of_test, pixel_xy,
)
from dieflow.operators.product import (
    SEGMENT_KEY, alike_names, counted_product, device_test_product, grid_join, numbered_product, product_grid, segment,
)

FACT_COLUMNS = [
    "wld_id", "wtp_id", "wp_pos_x", "wp_pos_y", "wptm_value", "wptm_created_date", "test_flag", "segment", "file_hash",
]
MIR_COLUMNS = ["facility", "operation", "lot_name", "equipment", "prog_name", "prog_version", "start_time"]

# Which file-header fields fill the context, with their fallbacks.
_MIR_SOURCES = {
    "default": {
        "facility": ("FACIL_ID", "FLOOR_ID"), "operation": ("OPER_NAM", "SPEC_NAM"), "lot_name": ("LOT_ID", "PART_TYP"),
        "equipment": ("NODE_NAM", "JOB_NAM"), "prog_name": ("JOB_REV",), "prog_version": ("SBLOT_ID",), "start_time": ("START_T",),
    },
    "direct": {
        "facility": ("FACIL_ID",), "operation": ("OPER_FRQ",), "lot_name": ("LOT_ID",), "equipment": ("NODE_NAM",),
        "prog_name": ("JOB_NAM",), "prog_version": ("JOB_REV",), "start_time": ("START_T",),
    },
}


def mir_context(mir: DataFrame, variant: str = "default") -> DataFrame:
    """The first header record of each file as seven context texts."""
    sources = _MIR_SOURCES[variant]
    needed = sorted({f for names in sources.values() for f in names})
    first = mir.groupBy("path").agg(F.min_by(F.struct(*needed), "record_index").alias("m"))
    columns = [first_non_empty(*[F.col(f"m.{n}").cast("string") for n in names]).alias(c) for c, names in sources.items()]
    return first.select("path", *columns)


def with_mir(df: DataFrame, context: DataFrame) -> DataFrame:
    """Attach the file context. One context row per file; the runtime picks broadcast by measured size."""
    joined = df.join(context, "path", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("")) for c in MIR_COLUMNS if c in context.columns})


def device_context(prr: DataFrame) -> DataFrame:
    """Part results to devices: name, bin, pass flag and default position."""
    bin_code = first_non_empty(F.col("soft_bin").cast("string"), F.col("hard_bin").cast("string"))
    return prr.select(
        "path",
        F.col("record_index").alias("device_index"),
        first_non_empty(F.col("part_id"), F.col("part_txt")).alias("wld_device_dmc"),
        bin_code.alias("bin_code"),
        bin_desc(bin_code).alias("bin_desc"),
        pass_flag(bin_code).alias("test_flag"),
        safe_int(F.col("x_coord")).alias("default_x"),
        safe_int(F.col("y_coord")).alias("default_y"),
    )


def test_values(tests: DataFrame, rule: str = "result_first") -> Column:
    """Values of a test as array<double>, never empty.

    ``result_first``: a non-zero single result of a PTR, else its result list, result or
    text, skipping what is no number. ``text_first``: an MPR's result list, else the
    test text. ``strict``: result list or result; one bad token gives [0.0].
    """
    types = {f.name.lower(): f.dataType for f in tests.schema}
    has_list = isinstance(types["rtn_rslt"], T.ArrayType)
    zero = F.array(F.lit(0.0))
    if has_list:
        listed = F.when(F.size("rtn_rslt") > 0, F.col("rtn_rslt").cast("array<double>"))
    else:
        listed = None
    if rule == "result_first":
        if has_list:
            single = F.when(F.col("record_type") == "PTR", F.array(F.coalesce(F.col("result"), F.lit(0.0)).cast("double")))
            return F.coalesce(single, listed, parse_values(F.col("test_txt")))
        result = safe_float(F.col("result"))
        text = first_non_empty(F.col("rtn_rslt"), F.col("result"), F.col("test_txt"))
        return F.when((F.col("record_type") == "PTR") & (result != 0.0), F.array(result)).otherwise(parse_values(text))
    if rule == "text_first":
        mpr = F.col("record_type") == "MPR"
        text = parse_values(F.col("test_txt"), "zero")
        if has_list:
            return F.coalesce(F.when(mpr, listed), text)
        return F.when(mpr & non_empty(F.col("rtn_rslt")).isNotNull(), parse_values(F.col("rtn_rslt"), "zero")).otherwise(text)
    if rule == "strict":
        if has_list:
            return F.coalesce(listed, F.when(F.col("result").isNotNull(), F.array(F.col("result").cast("double"))), zero)
        return parse_values_strict(first_non_empty(F.col("rtn_rslt"), F.col("result")))
    raise ValueError(f"unknown value rule {rule!r}")


def prepare_tests(
    tests: DataFrame,
    pixel_mode: str | None = "strict",
    source: str = "alarm_first",
    values: str = "result_first",
    axis_order: str = "col_row",
    zero_is_missing: bool = False,
) -> DataFrame:
    """Filter and shape tests once, below the product.

    Pixel coordinates stay NULL where a part's own position must be used.
    """
    alarm, text = F.col("alarm_id"), F.col("test_txt")
    kept = tests if pixel_mode is None else tests.filter(is_pixel_test(alarm, text, pixel_mode))
    if zero_is_missing:
        pixel = pixel_xy(param_source(alarm, text, source), axis_order)
        x, y = F.nullif(pixel["x"], F.lit(0)), F.nullif(pixel["y"], F.lit(0))
    else:
        pixel = pixel_of_test(alarm, text, axis_order)
        x, y = pixel["x"], pixel["y"]
    return kept.select(
        "path",
        "record_index",
        "record_type",
        F.col("test_num").cast("bigint").alias("test_num"),
        F.coalesce(F.col("test_flg"), F.lit(0)).cast("smallint").alias("test_flg"),
        clean_param(param_source(alarm, text, source)).alias("wtp_param_name"),
        test_values(tests, values).alias("values"),
        x.alias("pixel_x"),
        y.alias("pixel_y"),
        F.coalesce(F.col("units"), F.lit("")).alias("units"),
    )


# --- projections -------------------------------------------------------------------------


def measurement_tuple(product: DataFrame) -> DataFrame:
    """The 13 measurement columns, beside the file."""
    return product.select(
        "path", "wld_id", "wtp_id", "wp_pos_x", "wp_pos_y", "wptm_value", "test_flag", "segment", "file_hash",
        "wld_device_dmc", "wtp_param_name", "units", "test_num", "test_flg",
    )


def measurement_wide(product: DataFrame, variant: str = "full", source_label: str = "STDF_CPP") -> DataFrame:
    """The wide row with file context, device state and constants.

    The context columns come with the devices: ``with_mir`` joins them below the product,
    once per device, and ``keep`` carries them. ``full`` has the 25 columns;
    ``with_units`` adds units and the bin, without constants.
    """
    core = [
        F.col("facility").alias("wfi_facility"), F.col("operation").alias("wfi_operation"), F.col("lot_name").alias("wl_lot_name"),
        F.col("equipment").alias("wfi_equipment"), "wld_device_dmc", F.col("bin_code").alias("wld_bin_code"), "wp_pos_x", "wp_pos_y",
        "wtp_param_name", "wptm_value", "wtp_id", "wld_id", "test_num", "test_flg", "test_flag",
    ]
    if variant == "with_units":
        return product.select("path", *core, "units", "segment", "file_hash")
    constants = [
        F.lit("").alias("wld_phoenix_id"), F.lit("Y").alias("wld_latest"), F.col("bin_desc").alias("wld_bin_desc"),
        F.col("prog_name").alias("wmp_prog_name"), F.col("prog_version").alias("wmp_prog_version"),
        F.col("start_time").alias("wptm_created_date"), F.lit(source_label).alias("sft_name"), F.lit(source_label).alias("sft_group"),
        F.col("start_time").alias("wld_created_date"), "record_type",
    ]
    return product.select("path", *core, *constants)


def to_fact(measurements: DataFrame, load_ts: Column) -> DataFrame:
    """The nine stored columns with the load time."""
    return measurements.select(
        F.col("wld_id").cast("bigint"), F.col("wtp_id").cast("bigint"), F.col("wp_pos_x").cast("int"), F.col("wp_pos_y").cast("int"),
        F.col("wptm_value").cast("double"), load_ts.cast("timestamp").alias("wptm_created_date"),
        F.when(F.col("test_flag") != 0, 1).otherwise(0).cast("smallint").alias("test_flag"),
        F.coalesce(F.col("segment"), F.lit(0)).cast("bigint").alias("segment"), F.coalesce("file_hash", F.lit("")).alias("file_hash"),
    )


__all__ = [
    "FACT_COLUMNS", "MIR_COLUMNS", "SEGMENT_KEY", "alike_names", "counted_product", "device_context", "device_test_product", "grid_join", "measurement_tuple", "measurement_wide", "mir_context",
    "numbered_product", "prepare_tests", "product_grid", "segment", "test_values", "to_fact", "with_mir",
]
