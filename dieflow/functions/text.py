"""Parameter names, pixel coordinates and field names as native Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the tester's text convention.
PIXEL = r"Pixel=R(\d+)C(\d+)"
PIXEL_SUFFIX = r";Pixel=R\d+C\d+"
PIXEL_PREFIX = r"^Pixel=R\d+C\d+;"
PIXEL_HINTS = r"pixel=|r[0-9]+c[0-9]+|row.*col"
UNKNOWN_PARAM = "UNKNOWN_PARAM"


def non_empty(x: Column) -> Column:
    """NULL for empty text."""
    return F.nullif(x, F.lit(""))


def first_non_empty(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty; empty text when there is none."""
    return F.coalesce(*[non_empty(c) for c in candidates], F.lit(""))


def param_source(alarm_id: Column, test_txt: Column, source: str = "alarm_first") -> Column:
    """The text that names a parameter: ``alarm_first``, ``alarm_only`` or ``text_first``."""
    if source == "alarm_first":
        return first_non_empty(alarm_id, test_txt)
    if source == "alarm_only":
        return F.coalesce(alarm_id, F.lit(""))
    if source == "text_first":
        return first_non_empty(test_txt, alarm_id)
    raise ValueError(f"unknown parameter source {source!r}")


def is_pixel_test(alarm_id: Column, test_txt: Column, mode: str = "strict") -> Column:
    """Does the test belong to a pixel? ``strict``, ``either_case`` or ``hints``."""
    alarm_id, test_txt = F.coalesce(alarm_id, F.lit("")), F.coalesce(test_txt, F.lit(""))
    if mode == "strict":
        return alarm_id.contains("Pixel=") | test_txt.contains("Pixel=")
    if mode == "either_case":
        return alarm_id.rlike("[Pp]ixel=") | test_txt.rlike("[Pp]ixel=")
    if mode == "hints":
        return F.lower(F.concat_ws(" ", alarm_id, test_txt)).rlike(PIXEL_HINTS)
    raise ValueError(f"unknown pixel mode {mode!r}")


def pixel_xy(text: Column, axis_order: str = "col_row") -> Column:
    """``Pixel=R#C#`` to struct(x, y); both NULL without a match.

    The column is x and the row is y; ``axis_order="row_col"`` swaps them.
    """
    row = non_empty(F.regexp_extract(text, PIXEL, 1)).try_cast("int")
    col = non_empty(F.regexp_extract(text, PIXEL, 2)).try_cast("int")
    x, y = (col, row) if axis_order == "col_row" else (row, col)
    both = x.isNotNull() & y.isNotNull()
    return F.struct(F.when(both, x).alias("x"), F.when(both, y).alias("y"))


def pixel_of_test(alarm_id: Column, test_txt: Column, axis_order: str = "col_row") -> Column:
    """Pixel of a test: from the alarm text first, then from the test text."""
    alarm, text = pixel_xy(alarm_id, axis_order), pixel_xy(test_txt, axis_order)
    return F.when(alarm["x"].isNotNull(), alarm).otherwise(text)


def coordinates(
    alarm_id: Column,
    test_txt: Column,
    default_x: Column,
    default_y: Column,
    axis_order: str = "col_row",
    zero_is_missing: bool = False,
) -> Column:
    """struct(x, y) of a measurement, falling back to the part's own position.

    With ``zero_is_missing`` only the naming text is searched and a 0 on either
    axis falls back by itself.
    """
    if zero_is_missing:
        pixel = pixel_xy(param_source(alarm_id, test_txt), axis_order)
        x, y = F.nullif(pixel["x"], F.lit(0)), F.nullif(pixel["y"], F.lit(0))
    else:
        pixel = pixel_of_test(alarm_id, test_txt, axis_order)
        x, y = pixel["x"], pixel["y"]
    return F.struct(F.coalesce(x, default_x).alias("x"), F.coalesce(y, default_y).alias("y"))


def clean_param(name: Column) -> Column:
    """Drop the pixel part of a parameter name."""
    return F.regexp_replace(F.regexp_replace(name, PIXEL_SUFFIX, ""), PIXEL_PREFIX, "")


def clean_param_modsum(name: Column) -> Column:
    """Strip quotes; of a ``modSum`` name keep the second colon part up to its semicolon."""
    bare = F.trim(F.trim(name, F.lit('"')), F.lit("'"))
    part = F.split_part(F.split_part(bare, F.lit(":"), F.lit(2)), F.lit(";"), F.lit(1))
    return F.trim(F.when(bare.contains("modSum") & bare.contains(":"), part).otherwise(bare))


def clean_param_basic(name: Column) -> Column:
    """Trim; a missing name is ``UNKNOWN_PARAM``."""
    return F.when(F.coalesce(name, F.lit("")) == "", UNKNOWN_PARAM).otherwise(F.trim(name))


def normalize_name(name: Column) -> Column:
    """Field name in lower case without its ``rec_`` and ``stdf_`` prefixes."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), "^rec_", ""), "^stdf_", "")
