"""Number parsing and formatting as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.stage import computed_once

# Accepted number texts (fixed values): decimal and hexadecimal floats with single underscores
# between digits, and plain signed integers. Possessive groups keep the matcher iterative.
_DIGITS = r"[0-9]++(?:_[0-9]++)*+"
_HEX = r"[0-9a-fA-F]++(?:_[0-9a-fA-F]++)*+"
FLOAT_TEXT = (
    rf"\A[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    rf"|0[xX](?:_?{_HEX}(?:\.(?:{_HEX})?)?|\.{_HEX})[pP][+-]?{_DIGITS})\z"
)
INT_TEXT = r"\A[+-]?[0-9]+\z"

# Special float texts, compared in lower case (fixed values).
_POSITIVE_INFINITY = ("inf", "+inf", "infinity", "+infinity")
_NEGATIVE_INFINITY = ("-inf", "-infinity")
_NOT_A_NUMBER = "nan"

# From this many digits on, and for subnormal numbers, Double.toString may not be the shortest text.
_UNSURE_DIGITS = 16
_SMALLEST_NORMAL = 2.2250738585072014e-308
_EXACT_INTEGERS = float(2**53)
# Double.toString writes numbers from the first to below the second without an exponent.
_PLAIN_FROM, _PLAIN_TO = 1e-3, 1e7

_INF = float("inf")


def is_finite(v: Column) -> Column:
    return ~F.isnan(v) & (F.abs(v) < F.lit(_INF))


def finite_or_zero(v: Column) -> Column:
    """NaN and infinities become 0; NULL stays NULL."""
    return F.when(F.isnan(v) | (F.abs(v) == F.lit(_INF)), F.lit(0.0)).otherwise(v)


def float_literal(text: Column) -> Column:
    """DOUBLE of a number text, infinite where it overflows, NULL where it is not a number text."""
    plain = F.when(text.contains("_"), F.replace(text, F.lit("_"), F.lit(""))).otherwise(text)
    return F.when(text.rlike(FLOAT_TEXT), plain.try_cast("double"))


def float_value(literal: Column, text: Column) -> Column:
    """A parsed literal, NULL where it overflowed, or the meaning of a special word."""
    word = F.lower(text)
    return (
        F.when(F.abs(literal) < F.lit(_INF), literal)
        .when(literal.isNotNull(), F.lit(None).cast("double"))
        .when(word.isin(*_POSITIVE_INFINITY), F.lit(_INF))
        .when(word.isin(*_NEGATIVE_INFINITY), F.lit(-_INF))
        .when(word == _NOT_A_NUMBER, F.lit(float("nan")))
    )


def parse_float(text: Column) -> Column:
    """DOUBLE of a number text, NULL where it is not one or overflows the range."""
    return float_value(float_literal(text), text)


def parse_int(text: Column) -> Column:
    """BIGINT of a signed decimal text, NULL where it is not one or overflows the range."""
    return F.when(text.rlike(INT_TEXT), text.try_cast("bigint"))


def format_int(v: Column) -> Column:
    return v.cast("string")


def _exact(v: Column) -> Column:
    """Shortest text by Jackson's exact writer, which every Spark installation ships."""
    return F.java_method(
        F.lit("com.fasterxml.jackson.core.io.NumberOutput"), F.lit("toString"), v, F.lit(True)
    )


def _digits(text: Column) -> Column:
    """Digits of the mantissa. Two replacements are much faster than one ``translate``."""
    mantissa = F.substring_index(text, "E", 1)
    return F.replace(F.replace(mantissa, F.lit("-"), F.lit("")), F.lit("."), F.lit(""))


def _shortest(v: Column) -> Column:
    """Shortest text that reads back as ``v``, in the JVM's plain-or-E notation.

    A text of up to 15 digits is always the shortest for a normal number. For the others the JVM
    releases before 19 may print one digit too many.
    """
    text = v.cast("string")
    digits = F.length(_digits(text))
    unsure = (digits >= _UNSURE_DIGITS) | (F.abs(v) < F.lit(_SMALLEST_NORMAL))
    return F.when(unsure, _exact(v)).otherwise(text)


def _spread(text: Column) -> Column:
    """``-1.25E-7`` as ``-0.000000125``: the digits of an E-notation text, written out."""
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.substring_index(text, "E", 1)
    # The only trailing zero of such a text is the one of ``.0``.
    whole_digit = F.replace(F.substring_index(mantissa, ".", 1), F.lit("-"), F.lit(""))
    digits = F.when(mantissa.endswith(".0"), whole_digit).otherwise(_digits(text))
    exponent = F.substring_index(text, "E", -1).cast("int")
    whole = exponent + 1
    large = F.when(
        F.length(digits) <= whole, F.concat(digits, F.repeat(F.lit("0"), whole - F.length(digits)))
    ).otherwise(F.concat(F.substring(digits, F.lit(1), whole), F.lit("."), F.substring(digits, whole + 1, F.length(digits))))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    return F.concat(sign, F.when(exponent >= 0, large).otherwise(small))


def _one_digit(v: Column, text: Column) -> Column:
    """Shorten ``4.9E-324`` to ``5E-324`` where both read back as ``v``.

    The JVM writers always give two digits, which differs only next to the smallest number.
    """
    mantissa = F.substring_index(text, "E", 1)
    short = F.concat(F.round(mantissa.cast("double")).cast("int").cast("string"), F.substring(text, F.instr(text, "E"), F.lit(9)))
    value = short.try_cast("double")
    normal = F.when(short.rlike(r"\A-?10E"), F.concat(
        F.replace(F.substring_index(short, "E", 1), F.lit("10"), F.lit("1")),
        F.lit("E"), (F.substring_index(short, "E", -1).cast("int") + 1).cast("string"),
    )).otherwise(short)
    return F.when((F.length(_digits(text)) == 2) & (value == v), normal).otherwise(text)


def format_float(v: Column) -> Column:
    """Shortest round-trip digits of a DOUBLE, never with an exponent or a trailing ``.0``."""
    integer = (F.abs(v) <= F.lit(_EXACT_INTEGERS)) & (v == F.floor(v).cast("double"))
    tiny = F.abs(v) < F.lit(_SMALLEST_NORMAL)
    # The point is one of the characters, so a text of that length has a digit less.
    text = v.cast("string")
    plain = F.when(F.length(text) <= _UNSURE_DIGITS, text).otherwise(_exact(v))
    # A one-element array binds the text once for the many uses below; only E notation gets here.
    spread = F.transform(
        F.array(_shortest(v)),
        lambda t: F.when(t.contains("E"), _spread(F.when(tiny, _one_digit(v, t)).otherwise(t))).otherwise(t),
    )[0]
    return (
        F.when(F.isnan(v), F.lit("NaN"))
        .when(v == F.lit(_INF), F.lit("+Inf"))
        .when(v == F.lit(-_INF), F.lit("-Inf"))
        .when((v == 0) & text.startswith("-"), F.lit("-0"))
        .when(integer, v.try_cast("bigint").cast("string"))
        .when((F.abs(v) >= F.lit(_PLAIN_FROM)) & (F.abs(v) < F.lit(_PLAIN_TO)), plain)
        .when(v.isNotNull(), spread)
    )


def parse_operands(rows: DataFrame, kind: str = "type", raw: str = "raw_value") -> DataFrame:
    """Add ``value`` / ``delta``, parsed from the text by kind."""
    gauge, text = F.col(kind) == "gauge", F.col(raw)
    parsed = computed_once(
        rows,
        literal=F.when(gauge, float_literal(text)),
        delta=F.when(F.col(kind) == "counter", parse_int(text)),
    )
    return parsed.withColumn("value", F.when(gauge, float_value(F.col("literal"), text))).drop("literal")


def exact_sum(delta: str) -> Column:
    """Sum of BIGINTs as a DECIMAL(38,0), which 10^19 of them cannot overflow."""
    return F.sum(F.col(delta).cast("decimal(28,0)"))


def as_bigint(total: Column, overflow: str) -> Column:
    """An exact total as BIGINT: ``overflow='error'`` fails beyond its range, ``'wrap'`` goes modulo 2^64."""
    if overflow not in ("error", "wrap"):
        raise ValueError(f"unknown overflow mode {overflow!r}")
    half = F.lit(str(2**63)).cast("decimal(20,0)")
    if overflow == "wrap":
        full = F.lit(str(2**64)).cast("decimal(20,0)")
        return (F.pmod(total + half, full) - half).cast("bigint")
    fits = (total >= -half) & (total < half)
    failed = F.raise_error(F.lit("counter overflow")).cast("bigint")
    return F.when(total.isNull() | fits, total.try_cast("bigint")).otherwise(failed)


def wrapping_sum(v: Column) -> Column:
    """Sum of BIGINTs modulo 2^64, as two's-complement addition gives it."""
    return as_bigint(F.sum(v.cast("decimal(28,0)")), "wrap")
