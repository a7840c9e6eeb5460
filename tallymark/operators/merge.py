"""Merging updates, snapshots and renames into stored state.

Every merge is a union of tagged rows followed by one fold. Against an outer join of the two sides
this saves a shuffle and combines rows before the one that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import schema as S
from tallymark.operators.fold import add_deltas, kept_uuid, last_value, with_uuids
from tallymark.operators.validate import blank, check_snapshot, require

#: Wide enough for ``pack_order`` of every batch.
_ORDER = "decimal(38,0)"
_BEFORE_ALL = str(-(10**38 - 1))


def _old(state: DataFrame, ts: bool, ids: bool) -> DataFrame:
    rows = with_uuids(state) if ids else state
    kept = [*S.KEY, "value", "delta", F.lit(_BEFORE_ALL).cast(_ORDER).alias("seq"), F.lit(False).alias("fresh")]
    return rows.select(*kept, *(["created_at", "updated_at"] if ts else []), *(["id_high", "id_low"] if ids else []))


def _new(rows: DataFrame, order: Column, ts: Column | None, ids: bool) -> DataFrame:
    rows = with_uuids(rows) if ids else rows
    times = [] if ts is None else [ts.alias("created_at"), ts.alias("updated_at")]
    kept = [*S.KEY, "value", "delta", order.cast(_ORDER).alias("seq"), F.lit(True).alias("fresh")]
    return rows.select(*kept, *times, *(["id_high", "id_low"] if ids else []))


def _kept(ts: bool, ids: str | None) -> list[Column]:
    """What a key keeps besides its operand: its id, the time it was created, the time of its last update."""
    times = [F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at")] if ts else []
    return [*([kept_uuid("seq", ids).alias("id")] if ids else []), *times]


def upsert(
    state: DataFrame, updates: DataFrame, order: str = "seq", overflow: str = "error", ts: str | None = None, ids: str | None = None
) -> DataFrame:
    """Apply valid updates: a gauge takes their last value, a counter adds their sum.

    With ``ts``, the updates' time column, ``created_at`` and ``updated_at`` of the state are kept up. With ``ids``
    ('first', or 'last' for the newest id of a gauge) so is ``id``, a UUID in both inputs.
    """
    time = None if ts is None else F.col(ts)
    rows = _old(state, ts is not None, ids is not None).unionByName(_new(updates, F.col(order), time, ids is not None))
    return rows.groupBy(*S.KEY).agg(
        *([kept_uuid("seq", ids).alias("id")] if ids else []),
        last_value("seq").alias("value"),
        add_deltas(F.col("delta"), overflow).alias("delta"),
        *_kept(ts is not None, None),
    )


def replace(
    state: DataFrame, rows: DataFrame, order: str | None = None, ts: Column | None = None, ids: str | None = None
) -> DataFrame:
    """Set semantics for both kinds: the row from ``rows`` wins, counters are not added.

    ``order`` decides among several rows of one key, and a row without one fails; without ``order`` a key that
    occurs twice fails. ``ts`` is the time of the merge, for ``created_at`` and ``updated_at``; ``ids`` as in ``upsert``.
    """
    new = _new(rows, F.col(order) if order else F.lit(0), ts, ids is not None)
    both = _old(state, ts is not None, ids is not None).unionByName(new)
    lost = F.count_if(F.col("seq").isNull()) > 0
    several = F.lit(False) if order else F.count_if("fresh") > 1
    failed = F.when(lost, F.lit("replacement without an order: ")).when(several, F.lit("key occurs twice: "))
    newest = lambda c, kind: F.when(
        failed.isNotNull(), F.raise_error(F.concat(failed, F.col("name"))).cast(kind)
    ).otherwise(F.max_by(c, "seq"))
    return both.groupBy(*S.KEY).agg(
        newest("value", "double").alias("value"), newest("delta", "bigint").alias("delta"), *_kept(ts is not None, ids)
    )


def merge_add(
    state: DataFrame, snapshot: DataFrame, order: str | None = None, overflow: str = "error", ts: Column | None = None
) -> DataFrame:
    """Merge snapshot rows: gauges are replaced, counters added.

    Without ``order`` a gauge that occurs twice fails, since either value could win. ``ts`` is the time of the merge.
    """
    rows = snapshot.withColumnRenamed("id", "name")
    new = _new(rows, F.lit(0) if order is None else F.col(order), ts, False)
    both = _old(state, ts is not None, False).unionByName(new)
    several = F.count_if(F.col("fresh") & (F.col("type") == S.GAUGE)) > 1
    twice = F.raise_error(F.concat(F.lit("key occurs twice: "), F.col("name"))).cast("double")
    value = last_value("seq") if order else F.when(several, twice).otherwise(last_value("seq"))
    return both.groupBy(*S.KEY).agg(
        value.alias("value"), add_deltas(F.col("delta"), overflow).alias("delta"), *_kept(ts is not None, None)
    )


def restore(state: DataFrame, snapshot: DataFrame, order: str | None = None, ts: Column | None = None) -> DataFrame:
    """Replay a snapshot into state with set semantics; fails on the first bad row."""
    checked = check_snapshot(snapshot)
    rows = require(checked, F.col("error"), F.col("id"), "invalid snapshot row")
    return replace(state, rows.withColumnRenamed("id", "name"), order, ts)


def to_snapshot(state: DataFrame) -> DataFrame:
    """Snapshot rows of state: the name becomes the id, generated ids are not kept."""
    return state.select(F.col("name").alias("id"), "type", "value", "delta")


def key_violations(rows: DataFrame) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*S.KEY).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def rename(state: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rename keys by ``mapping(type, old, new)``; fails on an empty or a taken new name."""
    error = F.when(blank(F.col("new")), F.lit(S.NAME_EMPTY))
    names = require(mapping, error, F.col("old"), "cannot rename").select(
        "type", F.col("old").alias("name"), "new"
    )
    renamed = state.join(names, list(S.KEY), "left").withColumn("name", F.coalesce("new", "name"))
    once = F.when(F.count("*") == 1, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("name is taken: "), F.col("name"))).cast("boolean")
    )
    return (
        renamed.groupBy(*S.KEY)
        .agg(F.max("value").alias("value"), F.max("delta").alias("delta"), once.alias("once"))
        .where("once")
        .drop("once")
    )
