"""Number parsing and formatting, escaping and request paths, against Python."""

import math
import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.functions.numbers import (
    finite_or_zero,
    format_float,
    format_int,
    parse_float,
    parse_int,
    wrapping_sum,
)
from tallymark.functions.text import html_escape


def apply(spark, fn, values, kind):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def positional(v):
    if v == 0:
        return "-0" if math.copysign(1, v) < 0 else "0"
    text = format(Decimal(repr(v)), "f")
    return text.rstrip("0").rstrip(".") if "." in text else text


def test_format_float_is_shortest_and_positional(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1e23, 2e23, 5e-324, 1e-323, 2**-44, 1e21, 123.45, 1e7, -1e-7, 2.0**53 + 2, -(2.0**60)]
    values += [k * 5e-324 for k in range(1, 150)]
    values += [1.7976931348623157e308, 2.2250738585072014e-308, 0.1 + 0.2, 12345678.9]
    for _ in range(6000):
        v = struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0]
        if math.isfinite(v):
            values.append(v)
        values.append(round(rng.uniform(-1e6, 1e6), 2))
    assert apply(spark, format_float, values, "double") == [positional(v) for v in values]
    back = apply(spark, lambda c: parse_float(format_float(c)), values, "double")
    assert back == values


def test_format_float_specials(spark):
    values = [math.nan, math.inf, -math.inf, None]
    assert apply(spark, format_float, values, "double") == ["NaN", "+Inf", "-Inf", None]


FLOAT_TEXTS = [
    ("123.45", 123.45), ("+1.5", 1.5), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("1_0.5_0e1_0", 1.05e11),
    ("0x1p4", 16.0), ("0x1.8p-1", 0.75), ("0x_1p2", 4.0), ("1e-400", 0.0), ("-Inf", -math.inf),
    ("infinity", math.inf), ("abc", None), ("1.5d", None), ("1f", None), (" 1", None), ("1\n", None),
    ("1e400", None), ("1__0", None), ("_1", None), ("1_.5", None), ("0x1", None), (".", None), ("", None),
    ("+nan", None), ("infinit", None), ("１", None),
]


def test_parse_float(spark):
    texts = [text for text, _ in FLOAT_TEXTS]
    assert apply(spark, parse_float, texts, "string") == [want for _, want in FLOAT_TEXTS]


def test_parse_float_nan(spark):
    assert math.isnan(apply(spark, parse_float, ["nAn"], "string")[0])


def test_parse_float_of_a_long_text(spark):
    assert apply(spark, parse_float, ["1" * 100_000, "0." + "1_1" * 20_000], "string") == [None, pytest.approx(0.1111, abs=1e-4)]


def test_parse_int(spark):
    texts = ["7", "+7", "-7", "0" * 30 + "7", str(2**63 - 1), str(-(2**63)), str(2**63), "1.5", " 7", "7\n", "1_0", "", "abc"]
    want = [7, 7, -7, 7, 2**63 - 1, -(2**63), None, None, None, None, None, None, None]
    assert apply(spark, parse_int, texts, "string") == want
    assert apply(spark, format_int, [-5], "bigint") == ["-5"]


def test_finite_or_zero(spark):
    assert apply(spark, finite_or_zero, [math.nan, math.inf, -math.inf, 1.5, None], "double") == [0, 0, 0, 1.5, None]


def test_wrapping_sum_goes_modulo_two_to_the_64(spark):
    rows = spark.createDataFrame([(2**63 - 1,), (1,), (5,)], "d bigint")
    assert rows.select(wrapping_sum(F.col("d"))).first()[0] == -(2**63) + 5


def test_html_escape(spark):
    assert apply(spark, html_escape, ["a<b>&\"'+\0"], "string") == ["a&lt;b&gt;&amp;&#34;&#39;&#43;�"]
