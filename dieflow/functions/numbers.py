"""Number parsing as native Column expressions (no Python on the executors)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A complete decimal literal, and the longest leading one of a text.
_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_STRICT = rf"^\s*{_NUMBER}\s*$"
_PREFIX = rf"^\s*({_NUMBER})"
_INT_PREFIX = r"^\s*([+-]?\d+)"

UINT8_MAX = 255
UINT64_MAX = 2**64 - 1


def _try_double(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def safe_float(x: Column) -> Column:
    """Text to double; empty, NULL or malformed text is 0.0."""
    text = x.cast("string")
    return F.coalesce(F.when(text.rlike(_STRICT), _try_double(text)), F.lit(0.0))


def safe_int(x: Column) -> Column:
    """Text to int by truncating its float value; malformed or out of range is 0."""
    return F.coalesce(safe_float(x).try_cast("int"), F.lit(0))


def safe_uint(x: Column, bits: int = 64) -> Column:
    """Whole number clamped to an unsigned range; NULL, malformed or negative is 0.

    ``bits=8`` gives a smallint, ``bits=64`` a decimal(20,0).
    """
    top, spark_type = (UINT8_MAX, "smallint") if bits == 8 else (UINT64_MAX, "decimal(20,0)")
    whole = F.when(x.cast("string").rlike(r"^\s*[+-]?\d+\s*$"), F.trim(x.cast("string")).try_cast("decimal(38,0)"))
    zero, limit = F.lit(0).cast("decimal(38,0)"), F.lit(str(top)).cast("decimal(38,0)")
    return F.least(F.greatest(F.coalesce(whole, zero), zero), limit).cast(spark_type)


def number_prefix(x: Column) -> Column:
    """Leading number of a text ("1.5V" is 1.5); NULL when there is none."""
    return F.nullif(F.regexp_extract(x, _PREFIX, 1), F.lit("")).try_cast("double")


def int_prefix(x: Column) -> Column:
    """Leading whole number of a text ("1A" is 1); NULL when there is none."""
    return F.nullif(F.regexp_extract(x, _INT_PREFIX, 1), F.lit("")).try_cast("int")


def parse_values(text: Column, on_error: str = "skip") -> Column:
    """Comma list to array<double>, never empty.

    ``skip`` reads number prefixes and drops tokens without one; ``zero`` reads
    whole tokens only and turns bad ones into 0.0.
    """
    tokens = F.split(F.coalesce(text, F.lit("")), ",", -1)
    if on_error == "skip":
        values = F.filter(F.transform(tokens, number_prefix), lambda v: v.isNotNull())
    elif on_error == "zero":
        values = F.transform(F.filter(tokens, lambda t: F.trim(t) != ""), safe_float)
    else:
        raise ValueError(f"on_error must be 'skip' or 'zero', not {on_error!r}")
    return F.when(F.size(values) == 0, F.array(F.lit(0.0))).otherwise(values)


def parse_values_strict(text: Column) -> Column:
    """Comma list where one bad token voids the whole list: the result is then [0.0]."""
    tokens = F.filter(F.split(F.coalesce(text, F.lit("")), ",", -1), lambda t: F.trim(t) != "")
    usable = (F.size(tokens) > 0) & F.forall(tokens, lambda t: t.rlike(_STRICT))
    return F.when(usable, F.transform(tokens, _try_double)).otherwise(F.array(F.lit(0.0)))


def fixed_six(x: Column) -> Column:
    """Six decimals; an exact tie goes to the even digit."""
    text = F.format_string("%.6f", F.bround(x.cast("double"), 6))
    return _special(x).when(x.isNotNull(), text)


def six_digits(x: Column) -> Column:
    """Six significant digits, shortest form, exponent below 1e-4 and from 1e6 on.

    An exact tie goes to the even digit.
    """
    x = x.cast("double")
    scale = F.pow(F.lit(10.0), F.lit(5) - _exponent(_scientific(x)))
    scaled = F.abs(x) * scale
    down = (scaled - F.floor(scaled) == 0.5) & (F.floor(scaled) % 2 == 0)
    sci = _scientific(F.when(down, F.signum(x) * F.floor(scaled) / scale).otherwise(x))
    exponent = _exponent(sci)
    mantissa = F.regexp_replace(F.regexp_extract(sci, r"^(.*)e", 1), r"\.?0+$", "")
    fixed = F.regexp_replace(sci.try_cast("decimal(38,10)").cast("string"), r"\.?0+$", "")
    return (
        _special(x)
        .when(x == 0, "0")
        .when((exponent < -4) | (exponent >= 6), F.concat(mantissa, F.regexp_extract(sci, r"(e.*)$", 1)))
        .otherwise(fixed)
    )


def _scientific(x: Column) -> Column:
    return F.format_string("%.5e", x)


def _exponent(sci: Column) -> Column:
    return F.regexp_extract(sci, r"e([+-]\d+)$", 1).try_cast("int")


def _special(x: Column) -> Column:
    return F.when(F.isnan(x), "nan").when(F.abs(x) == F.lit(float("inf")), F.when(x > 0, "inf").otherwise("-inf"))
