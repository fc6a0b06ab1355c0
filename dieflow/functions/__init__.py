"""Scalar functions: every one is a native Column expression."""
from dieflow.functions.binary import bits_hex, bytes_hex, generic_values, nibbles, values_csv
from dieflow.functions.codes import (
    bin_desc, code_label, epoch_ts, file_hash, part_flags, pass_flag, record_type_name,
    synthetic_wld_id, tsr_flags, yyyymm,
)
from dieflow.functions.jsonfields import (
    json_array, json_float, json_float_or_null, json_int, json_string, json_uint, parse_record,
)
from dieflow.functions.numbers import (
    fixed_six, int_prefix, number_prefix, parse_values, parse_values_strict, safe_float, safe_int, safe_uint, six_digits,
)
from dieflow.functions.text import (
    clean_param, clean_param_basic, clean_param_modsum, coordinates, first_non_empty, is_pixel_test,
    non_empty, normalize_name, param_source, pixel_of_test, pixel_xy,
)

__all__ = [name for name in dir() if not name.startswith("_")]
