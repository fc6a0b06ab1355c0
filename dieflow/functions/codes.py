"""Record names, flags, code labels, ids and time helpers."""
from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from dieflow.functions.numbers import int_prefix

UNKNOWN_RECORD = "???"

# Fixed values of the STDF V4 format: single-letter and numeric codes.
CODE_LABELS: dict[str, dict[str, str]] = {
    "mode": {"A": "AEL", "C": "CHECKER", "D": "DEBUG", "E": "ENG", "M": "MAINTENANCE", "P": "PRODUCTION", "Q": "QUALITY"},
    "retest": {"Y": "YES", "N": "NO", " ": "UNKNOWN"},
    "bin": {"P": "PASS", "F": "FAIL", " ": "UNKNOWN"},
    "pin_group": {
        "0": "UNKNOWN", "10": "NORMAL", "20": "SCIO", "21": "SCIO_MID", "22": "SCIO_VALID",
        "23": "SCIO_SUS", "30": "DUAL", "31": "DUAL_MID", "32": "DUAL_VALID", "33": "DUAL_SUS",
    },
    "radix": {"0": "DEFAULT", "2": "BINARY", "8": "OCTAL", "10": "DECIMAL", "16": "HEX", "20": "SYMBOLIC"},
    "units": {"0": "UNKNOWN", "1": "INCHES", "2": "CENTIMETERS", "3": "MILLIMETERS", "4": "MILS"},
    "flat": {"U": "UP", "D": "DOWN", "L": "LEFT", "R": "RIGHT", " ": "UNKNOWN"},
    "position": {"L": "LEFT", "R": "RIGHT", "U": "UP", "D": "DOWN", " ": "UNKNOWN"},
    "test_type": {"P": "PARAMETRIC", "F": "FUNCTIONAL", "M": "MULTIPLE", " ": "UNKNOWN"},
}
PART_FLAG_BITS = {"new_id": 0x01, "new_coord": 0x02, "aborted": 0x04, "failed": 0x08, "no_indication": 0x10}
TSR_FLAG_BITS = {"min_invalid": 0x01, "max_invalid": 0x02, "tim_invalid": 0x04, "sums_invalid": 0x10, "sqrs_invalid": 0x20}


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(pairs.items())])


def record_type_name(rec_typ: Column, rec_sub: Column, names: dict[tuple[int, int], str] | None = None) -> Column:
    """Three-letter record name; ``???`` for a type nobody registered."""
    if names is None:
        from dieflow.sources.registry import record_names

        names = record_names()
    table = _literal_map({typ * 256 + sub: name for (typ, sub), name in names.items()})
    return F.coalesce(table[rec_typ.cast("int") * 256 + rec_sub.cast("int")], F.lit(UNKNOWN_RECORD))


def code_label(kind: str, code: Column) -> Column:
    """Readable label of a code; NULL when the format does not define it."""
    return _literal_map(CODE_LABELS[kind])[code.cast("string")]


def pass_flag(bin_code: Column) -> Column:
    """1 when the bin is number 1, else 0; NULL and garbage are 0."""
    return F.when(int_prefix(bin_code.cast("string")) == 1, 1).otherwise(0).cast("smallint")


def bin_desc(bin_code: Column) -> Column:
    return F.when(int_prefix(bin_code.cast("string")) == 1, "PASS").otherwise("FAIL")


def _bits(flag: Column, table: dict[str, int]) -> Column:
    return F.struct(*[(flag.cast("int").bitwiseAND(F.lit(mask)) != 0).alias(name) for name, mask in table.items()])


def part_flags(flag: Column) -> Column:
    """struct of booleans for the part flag byte."""
    return _bits(flag, PART_FLAG_BITS)


def tsr_flags(flag: Column) -> Column:
    """struct of booleans for the synopsis option byte."""
    return _bits(flag, TSR_FLAG_BITS)


def file_hash(content: Column) -> Column:
    """MD5 hex of a file's bytes."""
    return F.md5(content)


def synthetic_wld_id(path: Column, record_index: Column) -> Column:
    """Repeatable 31-bit hash of the file name plus the record's place in it."""
    return F.conv(F.substring(F.md5(path), 1, 8), 16, 10).cast("bigint").bitwiseAND(F.lit(0x7FFFFFFF)) + record_index


def epoch_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def yyyymm(ts: Column) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")
