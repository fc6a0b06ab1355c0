"""Scalar functions on literals with exact expected values."""
import math

import pytest
from pyspark.sql import functions as F

from dieflow import functions as fn
from dieflow.functions import jsonfields, numbers
from dieflow.functions.sqlfunctions import register_sql_functions


def values(spark, inputs, schema, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {schema}")
    rows = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    return [tuple(r)[1] if len(columns) == 1 else tuple(r)[1:] for r in rows]


X = F.col("x")


def test_safe_numbers(spark):
    texts = ["1.5", " -2e3 ", "", None, "bad", "1.5V", "1.5d", ".5", "7."]
    assert values(spark, texts, "string", fn.safe_float(X)) == [1.5, -2000.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.5, 7.0]
    assert values(spark, ["1.9", "-1.9", "x", None, "1e99"], "string", fn.safe_int(X)) == [1, -1, 0, 0, 0]
    assert values(spark, ["-1", "0", "255", "256", "1.5", "", None], "string", fn.safe_uint(X, 8)) == [0, 0, 255, 255, 0, 0, 0]
    big = values(spark, ["18446744073709551615", "18446744073709551616", "99999999999999999999999"], "string", fn.safe_uint(X))
    assert [int(b) for b in big] == [2**64 - 1] * 3


def test_number_prefix(spark):
    assert values(spark, ["1.5V", " -3e2x", "x1", "", None, "5."], "string", fn.number_prefix(X)) == [1.5, -300.0, None, None, None, 5.0]
    assert values(spark, ["1A", " +2", "A1", "99999999999"], "string", fn.int_prefix(X)) == [1, 2, None, None]


def test_parse_values(spark):
    texts = ["1,2.5, 3V ,bad,", "7", "", None, "bad", ",,"]
    assert values(spark, texts, "string", fn.parse_values(X)) == [[1.0, 2.5, 3.0], [7.0], [0.0], [0.0], [0.0], [0.0]]
    assert values(spark, texts, "string", fn.parse_values(X, "zero")) == [[1.0, 2.5, 0.0, 0.0], [7.0], [0.0], [0.0], [0.0], [0.0]]
    assert values(spark, texts, "string", fn.parse_values_strict(X)) == [[0.0], [7.0], [0.0], [0.0], [0.0], [0.0]]


def test_six_digits_matches_printf_g(spark):
    numbers = [0.0, 1.0, -1.5, 123456.0, 1234567.0, 0.0001, 0.00001234567, 1e10, 3.14159265, 100000.5, -2.5e-7, 1e300, 1000.125, 1000.375, -100001.5, 999999.5]
    assert values(spark, numbers, "double", fn.six_digits(X)) == ["%g" % n for n in numbers]
    assert values(spark, [math.inf, -math.inf, math.nan], "double", fn.six_digits(X)) == ["inf", "-inf", "nan"]


def test_fixed_six_matches_printf_f(spark):
    numbers = [0.0, 1 / 128, 3 / 128, -5 / 128, 1.23456789, 900.0999755859375, -0.1, 123456789.0]
    assert values(spark, numbers, "double", fn.fixed_six(X)) == ["%.6f" % n for n in numbers]
    assert values(spark, [math.inf, math.nan], "double", fn.fixed_six(X)) == ["inf", "nan"]


def test_pixels(spark):
    texts = ["a;Pixel=R12C3", "Pixel=R0C7;b", "pixel=R1C2", "", None]
    xy = fn.pixel_xy(X)
    assert values(spark, texts, "string", xy["x"], xy["y"]) == [(3, 12), (7, 0), (None, None), (None, None), (None, None)]
    assert values(spark, texts, "string", fn.is_pixel_test(X, F.lit(""))) == [True, True, False, False, False]
    assert values(spark, texts, "string", fn.is_pixel_test(X, F.lit(""), "either_case")) == [True, True, True, False, False]
    assert values(spark, ["row 1 col 2", "r1c2", "none"], "string", fn.is_pixel_test(X, F.lit(""), "hints")) == [True, True, False]
    c = fn.coordinates(X, F.lit("Pixel=R5C6"), F.lit(-1), F.lit(-2))
    assert values(spark, texts, "string", c["x"], c["y"]) == [(3, 12), (7, 0), (6, 5), (6, 5), (6, 5)]
    z = fn.coordinates(X, F.lit("Pixel=R5C6"), F.lit(-1), F.lit(-2), zero_is_missing=True)
    assert values(spark, texts, "string", z["x"], z["y"]) == [(3, 12), (7, -2), (-1, -2), (6, 5), (6, 5)]


def test_names(spark):
    assert values(spark, ["a;Pixel=R1C2;b", "Pixel=R1C2;a", "a", ""], "string", fn.clean_param(X)) == ["a;b", "a", "a", ""]
    texts = ["StaticPowerDiss:iddp_SLEEP;Mode=SLEEP;modSum;", '"plain"', "'q:r;modSum'", "modSum", " a "]
    assert values(spark, texts, "string", fn.clean_param_modsum(X)) == ["iddp_SLEEP", "plain", "r", "modSum", "a"]
    assert values(spark, [" a ", "", None], "string", fn.clean_param_basic(X)) == ["a", "UNKNOWN_PARAM", "UNKNOWN_PARAM"]
    assert values(spark, ["REC_STDF_A", "stdf_rec_b", "C"], "string", fn.normalize_name(X)) == ["a", "rec_b", "c"]


@pytest.mark.parametrize("code,flag", [("1", 1), ("1A", 1), ("01", 1), ("10", 0), ("", 0), (None, 0), ("x", 0)])
def test_pass_flag(spark, code, flag):
    assert values(spark, [code], "string", fn.pass_flag(X), fn.bin_desc(X)) == [(flag, "PASS" if flag else "FAIL")]


def test_codes(spark):
    assert values(spark, [0, 1, 20, 99], "int", fn.code_label("pin_group", X)) == ["UNKNOWN", None, "SCIO", None]
    assert values(spark, ["P", "F", " ", "x"], "string", fn.code_label("bin", X)) == ["PASS", "FAIL", "UNKNOWN", None]
    part = fn.part_flags(X)
    assert values(spark, [0, 0x0C, 0x1F], "int", part["aborted"], part["failed"], part["new_id"]) == [(False, False, False), (True, True, False), (True, True, True)]
    assert values(spark, [10, 15, 20, 11], "int", fn.record_type_name(F.lit(15), X)) == ["PTR", "MPR", "FTR", "???"]


def test_binary(spark):
    data = [bytearray(b"\x1f\xa0"), bytearray(b"")]
    assert values(spark, data, "binary", fn.nibbles(X, F.lit(3))) [0] == [1, 15, 10]
    assert values(spark, data, "binary", fn.nibbles(X, F.lit(0))) == [None, None]
    assert values(spark, data, "binary", fn.bytes_hex(X)) == ["1FA0", ""]


def test_synthetic_id_repeats_and_is_positive(spark):
    ids = values(spark, ["a", "a", "b"], "string", fn.synthetic_wld_id(X, F.lit(5)))
    assert ids[0] == ids[1] != ids[2] and all(5 <= i <= 0x7FFFFFFF + 5 for i in ids)


ODD_TEXTS = [
    None, "", " ", "1", " 1 ", "\t1\t", "1.5V", "-2", "+3.25e2", "1e400", "256", "-7", "18446744073709551616", "99999999999", "abc", "1,2.5,x,3V", ",,", "Pixel=R1C2",
    "a;Pixel=R3C40;b", "Pixel=R3C4;name", "Pixel=R99999999999C1", "pixel=R1C1", "'quo\"ted'", "\"a modSum:part two;rest\"", "modSum", "REC_STDF_x", "stdf_rec", "P", "Y", "20",
    "[1, 2.5]", "[bad", "1.0",
]


def test_sql_functions_equal_their_columns(spark):
    names = register_sql_functions(spark)
    c, flag = F.col("x"), F.col("i")
    pairs = {
        "safe_float(x)": fn.safe_float(c), "safe_int(x)": fn.safe_int(c), "safe_uint8(x)": fn.safe_uint(c, 8), "safe_uint64(x)": fn.safe_uint(c, 64),
        "number_prefix(x)": fn.number_prefix(c), "int_prefix(x)": numbers.int_prefix(c), "parse_values(x)": fn.parse_values(c), "pixel_x(x)": fn.pixel_xy(c)["x"],
        "pixel_y(x)": fn.pixel_xy(c)["y"], "is_pixel_test(x, x)": fn.is_pixel_test(c, c), "clean_param(x)": fn.clean_param(c),
        "clean_param_modsum(x)": fn.clean_param_modsum(c), "clean_param_basic(x)": fn.clean_param_basic(c), "normalize_name(x)": fn.normalize_name(c),
        "pass_flag(x)": fn.pass_flag(c), "bin_desc(x)": fn.bin_desc(c), "code_label('mode', x)": fn.code_label("mode", c), "code_label('radix', x)": fn.code_label("radix", c),
        "part_flags(i)": fn.part_flags(flag), "tsr_flags(i)": fn.tsr_flags(flag), "record_type_name(15, i)": fn.record_type_name(F.lit(15), flag),
        "nibbles(b, i)": fn.nibbles(F.col("b"), flag), "json_uint(x)": jsonfields.json_uint(c), "json_int(x)": jsonfields.json_int(c), "json_float(x)": jsonfields.json_float(c),
        "json_string(x)": jsonfields.json_string(c), "json_array(x)": jsonfields.json_array(c, "double"), "epoch_ts(i)": fn.epoch_ts(flag), "yyyymm(epoch_ts(i))": fn.yyyymm(fn.epoch_ts(flag)),
    }
    assert {p.split("(")[0] for p in pairs} == {n.removeprefix("df_") for n in names}
    rows = [(t, i, bytes([i, 255 - i])) for i, t in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame(rows, "x string, i int, b binary")
    calls = {call: F.expr("df_" + call.replace("(epoch_ts", "(df_epoch_ts")) for call in pairs}
    wrong = df.select("x", "i", *[F.struct(calls[p].alias("sql"), pairs[p].alias("col"), calls[p].eqNullSafe(pairs[p]).alias("same")).alias(p) for p in pairs]).collect()
    assert [(r.x, p, r[p]) for r in wrong for p in pairs if not r[p].same] == []
