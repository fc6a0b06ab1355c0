"""The scalar functions for SQL users, as temporary SQL functions of the session.

Each body is one SQL expression, so calls are inlined and stay in the JVM. Patterns, code tables
and record names are those of the Column functions; ``tests/test_functions.py`` holds every
function against its Column form.
"""
from __future__ import annotations

from pyspark.sql import SparkSession

from dieflow.functions import codes, numbers, text
from dieflow.sources.registry import record_names


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _map(pairs: dict) -> str:
    return "map(" + ", ".join(f"{_quoted(k) if isinstance(k, str) else k}, {_quoted(v)}" for k, v in pairs.items()) + ")"


def _bits(table: dict[str, int]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', (flag & {mask}) <> 0" for name, mask in table.items()) + ")"


_STRICT, _PREFIX, _INT = _quoted(numbers._STRICT), _quoted(numbers._PREFIX), _quoted(numbers._INT_PREFIX)
_FLOAT = f"coalesce(CASE WHEN {{x}} RLIKE {_STRICT} THEN try_cast(trim({{x}}) AS DOUBLE) END, 0.0D)"
_NUMBER = f"try_cast(nullif(regexp_extract({{x}}, {_PREFIX}, 1), '') AS DOUBLE)"
_WHOLE = f"try_cast(nullif(regexp_extract({{x}}, {_INT}, 1), '') AS INT)"
_AXIS = f"try_cast(nullif(regexp_extract(x, {_quoted(text.PIXEL)}, {{}}), '') AS INT)"
_UINT = (
    "CAST(least(greatest(coalesce(CASE WHEN x RLIKE '^\\\\s*[+-]?\\\\d+\\\\s*$' THEN try_cast(trim(x) AS DECIMAL(38,0)) END, 0), 0), "
    "CAST({top} AS DECIMAL(38,0))) AS {kind})"
)
_SKIPPED = f"filter(transform(split(coalesce(x, ''), ',', -1), t -> {_NUMBER.format(x='t')}), v -> v IS NOT NULL)"
_BARE = "trim(BOTH '\\'' FROM trim(BOTH '\"' FROM x))"


def _functions() -> dict[str, str]:
    names = {typ * 256 + sub: name for (typ, sub), name in record_names().items()}
    labels = " ".join(f"WHEN '{kind}' THEN {_map(table)}" for kind, table in codes.CODE_LABELS.items())
    return {
        "safe_float(x STRING) RETURNS DOUBLE": _FLOAT.format(x="x"),
        "safe_int(x STRING) RETURNS INT": f"coalesce(try_cast({_FLOAT.format(x='x')} AS INT), 0)",
        "safe_uint8(x STRING) RETURNS SMALLINT": _UINT.format(top=numbers.UINT8_MAX, kind="SMALLINT"),
        "safe_uint64(x STRING) RETURNS DECIMAL(20,0)": _UINT.format(top=numbers.UINT64_MAX, kind="DECIMAL(20,0)"),
        "number_prefix(x STRING) RETURNS DOUBLE": _NUMBER.format(x="x"),
        "int_prefix(x STRING) RETURNS INT": _WHOLE.format(x="x"),
        "parse_values(x STRING) RETURNS ARRAY<DOUBLE>": f"CASE WHEN size({_SKIPPED}) = 0 THEN array(0.0D) ELSE {_SKIPPED} END",
        # Both axes count, or neither.
        "pixel_x(x STRING) RETURNS INT": f"CASE WHEN {_AXIS.format(1)} IS NOT NULL THEN {_AXIS.format(2)} END",
        "pixel_y(x STRING) RETURNS INT": f"CASE WHEN {_AXIS.format(2)} IS NOT NULL THEN {_AXIS.format(1)} END",
        "is_pixel_test(alarm_id STRING, test_txt STRING) RETURNS BOOLEAN":
            "contains(coalesce(alarm_id, ''), 'Pixel=') OR contains(coalesce(test_txt, ''), 'Pixel=')",
        "clean_param(x STRING) RETURNS STRING":
            f"regexp_replace(regexp_replace(x, {_quoted(text.PIXEL_SUFFIX)}, ''), {_quoted(text.PIXEL_PREFIX)}, '')",
        "clean_param_modsum(x STRING) RETURNS STRING":
            f"trim(CASE WHEN contains({_BARE}, 'modSum') AND contains({_BARE}, ':') THEN split_part(split_part({_BARE}, ':', 2), ';', 1) ELSE {_BARE} END)",
        "clean_param_basic(x STRING) RETURNS STRING": f"CASE WHEN coalesce(x, '') = '' THEN '{text.UNKNOWN_PARAM}' ELSE trim(x) END",
        "normalize_name(x STRING) RETURNS STRING": "regexp_replace(regexp_replace(lower(x), '^rec_', ''), '^stdf_', '')",
        "pass_flag(x STRING) RETURNS SMALLINT": f"CAST(CASE WHEN {_WHOLE.format(x='x')} = 1 THEN 1 ELSE 0 END AS SMALLINT)",
        "bin_desc(x STRING) RETURNS STRING": f"CASE WHEN {_WHOLE.format(x='x')} = 1 THEN 'PASS' ELSE 'FAIL' END",
        "code_label(kind STRING, code STRING) RETURNS STRING": f"(CASE kind {labels} END)[code]",
        "part_flags(flag INT) RETURNS STRUCT<" + ", ".join(f"{n}: BOOLEAN" for n in codes.PART_FLAG_BITS) + ">": _bits(codes.PART_FLAG_BITS),
        "tsr_flags(flag INT) RETURNS STRUCT<" + ", ".join(f"{n}: BOOLEAN" for n in codes.TSR_FLAG_BITS) + ">": _bits(codes.TSR_FLAG_BITS),
        "record_type_name(typ INT, sub INT) RETURNS STRING": f"coalesce({_map(names)}[typ * 256 + sub], '{codes.UNKNOWN_RECORD}')",
        "nibbles(data BINARY, n INT) RETURNS ARRAY<TINYINT>":
            "CASE WHEN n > 0 THEN transform(sequence(1, n), i -> try_cast(conv(substr(hex(data), i, 1), 16, 10) AS TINYINT)) END",
        "json_uint(x STRING) RETURNS BIGINT": f"greatest(coalesce(try_cast(x AS BIGINT), try_cast({_NUMBER.format(x='x')} AS BIGINT), 0L), 0L)",
        "json_int(x STRING) RETURNS INT": f"coalesce(try_cast(x AS INT), try_cast({_NUMBER.format(x='x')} AS INT), 0)",
        "json_float(x STRING) RETURNS DOUBLE": "coalesce(try_cast(x AS DOUBLE), 0.0D)",
        "json_string(x STRING) RETURNS STRING": "coalesce(x, '')",
        "json_array(x STRING) RETURNS ARRAY<DOUBLE>": "coalesce(from_json(x, 'array<double>'), CAST(array() AS ARRAY<DOUBLE>))",
        "epoch_ts(seconds BIGINT) RETURNS TIMESTAMP": "timestamp_seconds(seconds)",
        "yyyymm(ts TIMESTAMP) RETURNS INT": "year(ts) * 100 + month(ts)",
    }


def register_sql_functions(spark: SparkSession, prefix: str = "df_") -> list[str]:
    """Create the functions with ``prefix`` before their names; returns those names."""
    names = []
    for signature, body in _functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{signature} RETURN {body}")
        names.append(prefix + signature.split("(")[0])
    return names
