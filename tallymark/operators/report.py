"""Reports: ticks, cumulative state per tick, and outgoing JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark import schema as S
from tallymark.functions.numbers import as_bigint, exact_sum, finite_or_zero, parse_operands
from tallymark.operators.validate import unsupported

POLL_SECONDS = 2
REPORT_SECONDS = 10
DAY_SECONDS = 86400
#: Ticks of a key whose changes one window holds.
BUCKET_TICKS = 4096


def _ceil_div(a: Column, b: int) -> Column:
    return F.call_function("div", a + F.lit(b - 1), F.lit(b))


def tick(ts: Column, start: Column, seconds: int) -> Column:
    """Number of the first tick at or after ``ts``; tick n is ``n * seconds`` after ``start``, n >= 1.

    Times without a zone are compared as they are, so the session's zone has no part in it.
    """
    elapsed = F.timestamp_diff("MICROSECOND", start, ts)
    return F.greatest(_ceil_div(elapsed, seconds * 1_000_000), F.lit(1).cast("bigint"))


def start_of(rows: DataFrame, ts: str = "ts") -> Column:
    """Earliest time of a table as a scalar subquery."""
    return rows.agg(F.min(ts)).scalar()


def end_of(rows: DataFrame, ts: str = "ts") -> Column:
    """Latest time of a table as a scalar subquery."""
    return rows.agg(F.max(ts)).scalar()


def report_ticks(
    samples: DataFrame,
    ts: str = "ts",
    start: Column | None = None,
    poll_seconds: int = POLL_SECONDS,
    report_seconds: int = REPORT_SECONDS,
) -> DataFrame:
    """Add the ``poll_tick`` that reads each sample and the ``report_tick`` that first ships it.

    Where both ticks fall together the poll comes first.
    """
    begin = start_of(samples, ts) if start is None else start
    polled = samples.withColumn("poll_tick", tick(F.col(ts), begin, poll_seconds))
    return polled.withColumn("report_tick", _ceil_div(F.col("poll_tick") * poll_seconds, report_seconds))


def report_changes(updates: DataFrame, tick: str = "tick", order: str = "seq", overflow: str = "error") -> DataFrame:
    """What each tick changes: ``(type, name, tick, next_tick, value, delta)``, counters as running totals.

    Updates are first folded per key and tick. The running totals are prefix sums on two levels: inside buckets of
    ``BUCKET_TICKS`` ticks of a key, and over the totals of a key's buckets. A window so sees at most ``BUCKET_TICKS``
    changes or one row per bucket, however hot the key is and however long its history. ``next_tick`` is NULL in
    the last row of a key. Totals are exact until the end; ``overflow`` says what happens to one beyond BIGINT.
    """
    per_tick = updates.groupBy(*S.KEY, F.col(tick).alias("tick")).agg(
        F.max_by("value", order).alias("value"), exact_sum("delta").alias("added")
    )
    rows = per_tick.withColumn("bucket", F.expr(f"tick div {BUCKET_TICKS}"))
    buckets = rows.groupBy(*S.KEY, "bucket").agg(F.sum("added").alias("sum"), F.min("tick").alias("first"))
    over_buckets = Window.partitionBy(*S.KEY).orderBy("bucket")
    offsets = buckets.select(
        *[F.col(c).alias(f"own_{c}") for c in (*S.KEY, "bucket")],
        F.sum("sum").over(over_buckets.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.lead("first").over(over_buckets).alias("next_first"),
    )
    inside = Window.partitionBy(*S.KEY, "bucket").orderBy("tick")
    so_far = F.sum("added").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = rows.withColumns({"so_far": so_far, "next_inside": F.lead("tick").over(inside)})
    same = [F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in (*S.KEY, "bucket")]
    none = F.lit(0).cast("decimal(38,0)")
    total = F.when(F.coalesce("so_far", "before").isNotNull(), F.coalesce("so_far", none) + F.coalesce("before", none))
    return local.join(offsets, same).select(
        *S.KEY, "tick", F.coalesce("next_inside", "next_first").alias("next_tick"), "value", as_bigint(total, overflow).alias("delta")
    )


def report_cumulative(
    updates: DataFrame,
    tick: str = "tick",
    order: str = "seq",
    last_tick: Column | None = None,
    first_tick: Column | None = None,
    overflow: str = "error",
) -> DataFrame:
    """State shipped at the ticks from ``first_tick`` (default 1) to ``last_tick`` (default the last with an update): all
    keys seen so far, counters never reset.

    A change is repeated for the ticks up to the next one, so no key-by-tick grid is joined, and only ticks of the
    asked range are written out.
    """
    last = updates.agg(F.max(tick)).scalar() if last_tick is None else last_tick
    begin = F.col("tick") if first_tick is None else F.greatest(F.col("tick"), first_tick)
    changes = report_changes(updates, tick, order, overflow).withColumns(
        {"begin": begin, "until": F.least(F.coalesce(F.col("next_tick") - 1, last), last)}
    )
    shipped = changes.where(F.col("begin") <= F.col("until"))
    return shipped.select(F.explode(F.sequence("begin", "until")).alias("tick"), *S.KEY, "value", "delta")


def report_overcount(updates: DataFrame, tick: str = "tick", last_tick: Column | None = None, overflow: str = "error") -> DataFrame:
    """Counter totals a receiver reaches that adds up the cumulative reports.

    A delta of tick t is shipped again at each of the ticks t..last, which needs no tick grid.
    """
    last = updates.agg(F.max(tick)).scalar() if last_tick is None else last_tick
    counters = updates.where(F.col("type") == S.COUNTER)
    times = (last - F.col(tick) + 1).cast("decimal(18,0)")
    shipped = F.sum(F.col("delta").cast("decimal(19,0)") * times)
    return counters.groupBy("name").agg(as_bigint(shipped, overflow).alias("delta"))


def wire_json(kind: Column, name: Column, value: Column, delta: Column) -> Column:
    """JSON object of one metric; the missing operand is left out, non-finite values become 0."""
    return F.to_json(
        F.struct(name.alias("id"), kind.alias("type"), delta.alias("delta"), finite_or_zero(value).alias("value"))
    )


def wire_encode(rows: DataFrame) -> DataFrame:
    """Text items ``(type, name, raw_value)`` as JSON objects in ``payload``, or an ``error``."""
    kind, parsed = F.col("type"), parse_operands(rows)
    error = F.when(unsupported(kind), F.lit(S.UNSUPPORTED_TYPE)).when(
        F.col("value").isNull() & F.col("delta").isNull(), F.lit(S.INVALID_VALUE)
    )
    payload = wire_json(kind, F.col("name"), F.col("value"), F.col("delta"))
    checked = parsed.withColumn("error", error)
    return checked.withColumn("payload", F.when(F.col("error").isNull(), payload)).drop("value", "delta")


def report_payload(reports: DataFrame, parts: int = 1) -> DataFrame:
    """JSON-array payloads ``(tick, part, payload)`` of the shipped state, sorted inside by name.

    A report is one payload; ``parts`` splits every report by key hash into so many, whatever its size. Adding up
    consecutive batches gives the same state. A payload is one value in one task, so a caller with millions of keys
    chooses enough parts. Ticks without a key give no row, nor do parts without one.
    """
    item = F.struct(F.col("name").alias("id"), "type", "delta", finite_or_zero(F.col("value")).alias("value"))
    return (
        reports.withColumn("part", F.pmod(F.xxhash64(*S.KEY), F.lit(parts).cast("bigint")))
        .groupBy("tick", "part")
        .agg(F.to_json(F.array_sort(F.collect_list(item))).alias("payload"))
    )


def write_payloads(payloads: DataFrame, path: str) -> None:
    """Payload lines, gzip-compressed."""
    payloads.select("payload").write.option("compression", "gzip").text(path)


def interval_fold(
    updates: DataFrame, width: str, ts: str = "ts", order: str = "seq", watermark: str | None = None, overflow: str = "error"
) -> DataFrame:
    """Fold per report interval instead of over all time: last value and sum per key and interval.

    On a stream ``watermark`` lets closed intervals leave the state store.
    """
    rows = updates
    if watermark is not None:
        rows = updates.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    folded = rows.groupBy(F.window(ts, width), *S.KEY).agg(
        F.max_by("value", order).alias("value"), as_bigint(exact_sum("delta"), overflow).alias("delta")
    )
    return folded.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *S.KEY, "value", "delta")
