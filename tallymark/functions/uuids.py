"""UUID texts as two BIGINTs, so that ids are fixed-width aggregate buffers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UUID = r"\A[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z"


def _half(text: Column, first: int) -> Column:
    digits = F.substring(F.replace(text, F.lit("-"), F.lit("")), first, 16)
    value = F.conv(digits, 16, -10).cast("bigint")
    broken = F.raise_error(F.concat(F.lit("not a UUID: "), text)).cast("bigint")
    return F.when(text.isNotNull(), F.when(text.rlike(_UUID), value).otherwise(broken))


def uuid_high(text: Column) -> Column:
    """First 64 bits of a UUID text, NULL for NULL; fails on any other text."""
    return _half(text, 1)


def uuid_low(text: Column) -> Column:
    return _half(text, 17)


def uuid_text(high: Column, low: Column) -> Column:
    """The text of both halves, in lower case."""
    digits = F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))
    return F.concat_ws("-", *[F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
