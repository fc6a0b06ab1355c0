"""Readable forms of binary and array fields."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nibbles(data: Column, n: Column) -> Column:
    """First ``n`` 4-bit states of packed bytes, high half first; NULL when n is 0."""
    digits = F.hex(data)
    return F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(1), n.cast("int")),
            lambda i: F.conv(F.substr(digits, i, F.lit(1)), 16, 10).try_cast("tinyint"),
        ),
    )


def bytes_hex(data: Column) -> Column:
    return F.hex(data)


def bits_hex(bits: Column) -> Column:
    """Hex of a counted bit field struct(n_bits, bits)."""
    return F.hex(bits["bits"])


def values_csv(values: Column) -> Column:
    """Array to comma text, full precision."""
    return F.concat_ws(",", F.transform(values, lambda v: v.cast("string")))


def generic_values(data: Column) -> Column:
    """Generator over tagged values: one row (tag, value) each."""
    return F.inline(data)
