"""Runtime samples: wide polls into long updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import schema as S
from tallymark.functions.numbers import finite_or_zero

_HASH_RANGE = float(2**32)


def sample_columns(samples: DataFrame, ids: tuple[str, ...] = ("poll_id", "ts")) -> list[str]:
    """The runtime columns a sample table has, in their fixed order; a column of another name is an error."""
    unknown = set(samples.columns) - {*S.RUNTIME_NAMES, *ids, S.RANDOM_VALUE}
    if unknown:
        raise ValueError(f"not a reading: {', '.join(sorted(unknown))}")
    return [n for n in S.RUNTIME_NAMES if n in samples.columns]


def unpivot_samples(samples: DataFrame, ids: tuple[str, ...] = ("poll_id", "ts")) -> DataFrame:
    """One row ``(ids…, name, value)`` per reading, as read."""
    return samples.unpivot(list(ids), sample_columns(samples, ids), "name", "value")


def normalize_samples(long: DataFrame) -> DataFrame:
    """Readings that are not finite count as 0."""
    return long.withColumn("value", finite_or_zero(F.col("value")))


def random_value(key: Column, seed: int = 0) -> Column:
    """Uniform number in [0, 1) drawn per key.

    Hashing the key instead of ``rand()`` gives a recomputed task the same numbers again.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_HASH_RANGE)


def collect_samples(samples: DataFrame, poll: str = "poll_id", ids: tuple[str, ...] = ("poll_id", "ts"), seed: int = 0) -> DataFrame:
    """The updates of every poll: its readings, ``RandomValue``, and ``PollCount`` + 1.

    All come out of one unpivot, so the samples are scanned once and nothing is shuffled.
    """
    names = [*sample_columns(samples, (*ids, poll)), S.RANDOM_VALUE, S.POLL_COUNT]
    read = S.RANDOM_VALUE in samples.columns
    drawn = F.col(S.RANDOM_VALUE) if read else random_value(F.col(poll), seed)
    wide = samples.withColumns({S.RANDOM_VALUE: drawn, S.POLL_COUNT: F.lit(1.0)})
    long = normalize_samples(wide.unpivot(list(ids), names, "name", "value"))
    counts = F.col("name") == S.POLL_COUNT
    return long.select(
        *ids,
        F.when(counts, F.lit(S.COUNTER)).otherwise(F.lit(S.GAUGE)).alias("type"),
        "name",
        F.when(~counts, F.col("value")).alias("value"),
        F.when(counts, F.lit(1).cast("bigint")).alias("delta"),
    )


def poll_count(samples: DataFrame) -> DataFrame:
    """Counter ``PollCount`` after all polls."""
    return samples.agg(F.count("*").alias("delta")).select(
        F.lit(S.COUNTER).alias("type"), F.lit(S.POLL_COUNT).alias("name"), "delta"
    )
