"""Generated identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def random_id() -> Column:
    return F.uuid()


def time_ordered_id(ts: Column, *key: Column) -> Column:
    """Version-7 UUID: 48 bits of milliseconds, the rest drawn from the hash of a unique key.

    The same update gets the same id again when a lost task or a micro-batch is recomputed, in any time zone: a time
    without a zone counts as UTC. Times before 1970 have no such id and fail.
    """
    since = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))
    early = F.raise_error(F.lit("time before 1970 has no time-ordered id")).cast("bigint")
    millis = F.lpad(F.lower(F.hex(F.when(since < 0, early).otherwise(since))), 12, "0")
    digest = F.md5(F.concat_ws(":", *[k.cast("string") for k in key]))
    # The two bits 10 of the variant leave four digits for its place (fixed values).
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 4, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat(
        F.substring(millis, 1, 8), F.lit("-"), F.substring(millis, 9, 4),
        F.lit("-7"), F.substring(digest, 1, 3),
        F.lit("-"), variant, F.substring(digest, 5, 3),
        F.lit("-"), F.substring(digest, 8, 12),
    )


def assign_ids(updates: DataFrame, key: tuple[str, ...] = ("seq",), ts: str = "ts") -> DataFrame:
    """Give every update an ``id`` made from its time and its unique ``key``."""
    return updates.withColumn("id", time_ordered_id(F.col(ts), *[F.col(k) for k in key]))
