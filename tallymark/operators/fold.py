"""Folding an ordered update log into keyed state: gauges keep the last value, counters add up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import schema as S
from tallymark.functions.numbers import wrapping_sum
from tallymark.functions.uuids import uuid_high, uuid_low, uuid_text

# Positions inside a batch lie below this.
POSITIONS = 2**31


def pack_order(batch: Column, position: Column) -> Column:
    """One DECIMAL that sorts like ``(batch, position)`` for every BIGINT batch.

    Fails where the position is negative or 2^31 and more, or where either is NULL.
    """
    packed = batch.cast("decimal(19,0)") * F.lit(POSITIONS).cast("decimal(10,0)") + position.cast("decimal(10,0)")
    fits = batch.isNotNull() & (position >= 0) & (position < POSITIONS)
    wide = "decimal(38,0)"
    return F.when(fits, packed.cast(wide)).otherwise(F.raise_error(F.lit("batch order out of range")).cast(wide))


def last_value(order: str) -> Column:
    """Value of the newest gauge update; fails where a gauge update has no order."""
    lost = F.count_if((F.col("type") == S.GAUGE) & F.col(order).isNull())
    missing = F.raise_error(F.lit("gauge update without an order")).cast("double")
    return F.when(lost > 0, missing).otherwise(F.max_by("value", order))


def add_deltas(delta: Column, overflow: str) -> Column:
    """Counter sum: ``overflow='error'`` fails beyond BIGINT, ``'wrap'`` goes modulo 2^64."""
    if overflow not in ("error", "wrap"):
        raise ValueError(f"unknown overflow mode {overflow!r}")
    if overflow == "wrap":
        return wrapping_sum(delta)
    # try_sum gives NULL beyond the range whatever the session's ANSI setting is.
    total = F.try_sum(delta)
    overflown = total.isNull() & (F.count(delta) > 0)
    return F.when(overflown, F.raise_error(F.lit("counter overflow")).cast("bigint")).otherwise(total)


def fold_state(
    updates: DataFrame,
    order: str = "seq",
    overflow: str = "error",
    ts: str | None = None,
    ids: str | None = None,
) -> DataFrame:
    """State ``(type, name, value, delta)`` of valid updates; ``order`` must be unique per gauge.

    One hash aggregate with fixed-width buffers: a hot name shrinks to one row per task before the
    shuffle. ``ts`` adds ``created_at`` / ``updated_at``; ``ids`` adds the ``id`` each key keeps, as
    in ``fold_uuids``, and then ``order`` must be unique per key.
    """
    aggregates = [
        last_value(order).alias("value"),
        add_deltas(F.col("delta"), overflow).alias("delta"),
    ]
    if ts is not None:
        aggregates += [F.min(ts).alias("created_at"), F.max(ts).alias("updated_at")]
    if ids is None:
        return updates.groupBy(*S.KEY).agg(*aggregates)
    return with_uuids(updates).groupBy(*S.KEY).agg(kept_uuid(order, ids).alias("id"), *aggregates)


def with_uuids(updates: DataFrame) -> DataFrame:
    """The ``id`` of every row as two BIGINTs, ``id_high`` and ``id_low``."""
    return updates.withColumns({"id_high": uuid_high(F.col("id")), "id_low": uuid_low(F.col("id"))})


def kept_uuid(order: str, ids: str) -> Column:
    """The id a key keeps: the first one, or for gauges the last with ``ids='last'``; rows without an id do not count."""
    if ids not in ("first", "last"):
        raise ValueError(f"unknown id mode {ids!r}")
    rank = F.when(F.col("id_high").isNotNull(), F.col(order))
    first = uuid_text(F.min_by("id_high", rank), F.min_by("id_low", rank))
    last = uuid_text(F.max_by("id_high", rank), F.max_by("id_low", rank))
    return first if ids == "first" else F.when(F.col("type") == S.GAUGE, last).otherwise(first)


def fold_uuids(updates: DataFrame, order: str = "seq", ids: str = "first") -> DataFrame:
    """The UUID each key keeps: the first one, or for gauges the last with ``ids='last'``.

    Ids travel as two BIGINTs each, so this is a hash aggregate like the fold; ``order`` must be unique per key.
    """
    return with_uuids(updates).groupBy(*S.KEY).agg(kept_uuid(order, ids).alias("id"))


def fold_gauges(updates: DataFrame, order: str = "seq") -> DataFrame:
    gauges = updates.where(F.col("type") == S.GAUGE)
    return gauges.groupBy("name").agg(last_value(order).alias("value"))


def fold_counters(updates: DataFrame, overflow: str = "error") -> DataFrame:
    counters = updates.where(F.col("type") == S.COUNTER)
    return counters.groupBy("name").agg(add_deltas(F.col("delta"), overflow).alias("delta"))


def fold_ids(updates: DataFrame, order: str = "seq", gauge_id: str = "first") -> DataFrame:
    """The id of any text each key keeps: the first one, or for gauges the last with ``gauge_id='last'``.

    Text buffers need a sort-based aggregate; ``fold_uuids`` does without one.
    """
    if gauge_id not in ("first", "last"):
        raise ValueError(f"unknown gauge_id mode {gauge_id!r}")
    rank = F.col(order)
    if gauge_id == "last":
        rank = F.when(F.col("type") == S.GAUGE, -rank).otherwise(rank)
    return updates.groupBy(*S.KEY).agg(F.min_by("id", rank).alias("id"))


def latest_rows(updates: DataFrame, order: str = "seq") -> DataFrame:
    """The whole newest row of every key.

    An aggregate rather than a ranking window, so a hot key is reduced before the shuffle.
    """
    row = F.struct(*updates.columns)
    return updates.groupBy(*S.KEY).agg(F.max_by(row, order).alias("row")).select("row.*")
