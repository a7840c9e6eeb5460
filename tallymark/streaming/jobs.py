"""Continuous fold and durable upsert of update streams."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymark import schema as S
from tallymark.operators.fold import add_deltas, fold_state, pack_order
from tallymark.operators.validate import check_text, valid
from tallymark.sources.files import file_system
from tallymark.sources.snapshots import load_snapshot, save_snapshot
from tallymark.sources.updates import decode_batches, decode_updates
from tallymark.streaming.batches import COLUMNS, whole_batches
from tallymark.streaming.store import StateStore

log = logging.getLogger(__name__)

STORE_INTERVAL = "300 seconds"
#: What the state of a fold stream holds of a key: the buffers of the fold's aggregates, told apart by their place only.
#: The order may be of any type; the stream itself fails on lost orders and on overflow.
FOLDED = (
    ("lost", "bigint"), ("value", "double"), ("order", "string"), ("total", "bigint"), ("empty", "boolean"), ("deltas", "bigint"),
    ("created_at", "timestamp_ntz"), ("updated_at", "timestamp_ntz"),
)
FOLDED_ORDER = 2
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the start of one query, which keeps its own copy of them."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _trigger(interval: str | None) -> dict:
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def run_fold(
    updates: DataFrame,
    target: str,
    interval: str | None = None,
    state_partitions: int | None = None,
    ts: str = "ts",
    snapshot: str | None = None,
    copy: bool = True,
) -> StreamingQuery:
    """Fold a stream of valid updates into ever-growing state.

    The state lives in RocksDB, outside the JVM heap; each micro-batch stores the keys it changed
    below ``target``, where ``read_fold`` finds the whole. With ``copy=False`` nothing but the checkpoint is written, and
    ``read_running`` reads the state from there. ``interval=None`` stops when the input
    is used up. ``state_partitions`` is fixed at the first start of a target. With ``snapshot`` a new target
    starts from that snapshot: it is kept below ``target`` as the base that ``read_fold`` adds the stream's totals to.
    """
    spark = updates.sparkSession
    store = _fold_store(spark, target)
    base = _base_store(spark, target)
    if snapshot and store.is_new() and base.is_new() and not _has_committed(spark, target):
        base.restore(load_snapshot(spark, snapshot), F.current_timestamp().cast("timestamp_ntz"))
    timed = updates.withColumn(ts, F.col(ts).cast("timestamp_ntz"))
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    writer = fold_state(timed, ts=ts).writeStream.outputMode("update").trigger(**_trigger(interval))
    writer = writer.option("checkpointLocation", _checkpoint(target))
    writer = writer.foreachBatch(lambda rows, epoch: store.put(rows, epoch)) if copy else writer.format("noop")
    with _settings(spark, settings):
        return writer.start()


def _checkpoint(target: str) -> str:
    return f"{target.rstrip('/')}/checkpoint"


def _has_committed(spark: SparkSession, target: str) -> bool:
    fs, commits = file_system(spark, f"{_checkpoint(target)}/commits/[0-9]*")
    return bool(fs.globStatus(commits))


def _fold_store(spark: SparkSession, target: str) -> StateStore:
    return StateStore(spark, f"{target.rstrip('/')}/state", add=False)


def _base_store(spark: SparkSession, target: str) -> StateStore:
    return StateStore(spark, f"{target.rstrip('/')}/base")


def read_fold(spark: SparkSession, target: str) -> DataFrame:
    """State a fold stream has written so far, on top of the snapshot it started from."""
    return _on_base(spark, target, _fold_store(spark, target).read())


def read_running(spark: SparkSession, target: str, batch: int | None = None) -> DataFrame:
    """State of a fold stream after its last micro-batch, or after ``batch``, on top of the snapshot it started from.

    Read from the stream's own state, one task per state partition, also while the stream runs. How many earlier
    micro-batches can be read is set by ``spark.sql.streaming.minBatchesToRetain`` when the stream is started.
    """
    reader = spark.read.format("statestore")
    rows = (reader if batch is None else reader.option("batchId", batch)).load(_checkpoint(target))
    held = [f.dataType.simpleString() for f in rows.schema["value"].dataType.fields]
    if [t for i, t in enumerate(held) if i != FOLDED_ORDER] != [t for i, (_, t) in enumerate(FOLDED) if i != FOLDED_ORDER]:
        raise RuntimeError(f"state of another layout: {held}")
    named = rows.select("key.*", F.col("value").cast(f"struct<{','.join(f'{n}:{t}' for n, t in FOLDED)}>").alias("kept"))
    delta = F.when(~F.col("kept.empty"), F.col("kept.total"))
    return _on_base(spark, target, named.select(*S.KEY, "kept.value", delta.alias("delta"), "kept.created_at", "kept.updated_at"))


def _on_base(spark: SparkSession, target: str, running: DataFrame) -> DataFrame:
    base = _base_store(spark, target)
    if base.is_new():
        return running
    rows = base.read().withColumn("part", F.lit(0)).unionByName(running.withColumn("part", F.lit(1)))
    return rows.groupBy(*S.KEY).agg(
        F.max_by("value", "part").alias("value"),
        add_deltas(F.col("delta"), "error").alias("delta"),
        F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
    )


def batch_documents(docs: DataFrame) -> DataFrame:
    """Checked updates of JSON-array documents ``(batch_id, ts, doc)``, ordered by batch and position."""
    return decode_batches(docs).withColumn("seq", F.when(F.col("error").isNull(), pack_order(F.col("batch_id"), F.col("pos"))))


def single_documents(docs: DataFrame) -> DataFrame:
    """Checked updates of single JSON documents ``(seq, ts, doc)``."""
    return decode_updates(docs)


def text_updates(rows: DataFrame) -> DataFrame:
    """Checked text updates ``(seq, ts, type, name, raw_value)``."""
    return check_text(rows)


def run_upsert(
    docs: DataFrame,
    target: str,
    interval: str | None = STORE_INTERVAL,
    snapshot: str | None = None,
    sync: bool = False,
    restore: bool = True,
    rejects: Callable[[DataFrame, int], None] | None = None,
    decode: Callable[[DataFrame], DataFrame] = batch_documents,
    save_every: float | None = None,
) -> StreamingQuery:
    """Apply a stream of updates to the store below ``target``; ``decode`` turns its rows into checked updates.

    ``batch_documents``, ``single_documents`` and ``text_updates`` are the decoders. A document is
    applied whole or not at all, and a replayed micro-batch changes nothing. With ``snapshot`` an
    empty store starts from that snapshot if ``restore`` is set; ``sync`` saves a new one after
    every micro-batch, ``save_every`` once so many seconds have passed since the last, ``run_saves`` also
    while no data arrive. A failing
    save is logged and the stream goes on. ``rejects`` gets the refused rows of each micro-batch
    that has not been applied yet.
    """
    spark = docs.sparkSession
    store = open_store(spark, target)
    if snapshot and restore and store.is_new():
        store.restore(load_snapshot(spark, snapshot), F.current_timestamp().cast("timestamp_ntz"))

    saved = time.monotonic()

    def apply(batch: DataFrame, epoch: int) -> None:
        nonlocal saved
        if epoch <= store.applied():
            return
        checked = decode(batch)
        if rejects is not None:
            rejects(checked.where(F.col("error").isNotNull()), epoch)
        store.apply(valid(checked), epoch)
        due = save_every is not None and time.monotonic() - saved >= save_every
        if snapshot and (sync or due):
            saved = time.monotonic()
            _try_save(store, snapshot)

    return (
        docs.writeStream.option("checkpointLocation", f"{target.rstrip('/')}/checkpoint")
        .trigger(**_trigger(interval))
        .foreachBatch(apply)
        .start()
    )


def run_saves(spark: SparkSession, target: str, snapshot: str, every: str = STORE_INTERVAL) -> StreamingQuery:
    """Save a snapshot of the store below ``target`` on every tick on which it has changed since the last save.

    The ticks come from a stream of their own, so the last change is saved even if no further update ever arrives. A
    failing save is logged and tried again on the next tick. Runs until it is stopped.
    """
    store, saved = open_store(spark, target), None

    def save(_: DataFrame, tick: int) -> None:
        nonlocal saved
        applied = None if store.is_new() else store.applied()
        if applied != saved and _try_save(store, snapshot):
            saved = applied

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = ticks.writeStream.option("checkpointLocation", f"{target.rstrip('/')}/saves").foreachBatch(save)
    return writer.trigger(processingTime=every).start()


def _try_save(store: StateStore, snapshot: str) -> bool:
    try:
        save_snapshot(store.read(), snapshot)
    except Exception:
        log.exception("snapshot save failed")
        return False
    return True


def run_whole_batches(
    checked: DataFrame, target: str, interval: str | None = None, state_partitions: int | None = None, timeout_ms: int | None = None
) -> StreamingQuery:
    """Write the rows of a stream of checked rows below ``target``/rows, all or none of each batch.

    Batches may be spread over micro-batches; see ``whole_batches``. ``read_whole_batches`` reads what has been
    released. ``state_partitions`` is fixed at the first start of a target.
    """
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    base = target.rstrip("/")
    writer = (
        whole_batches(checked, timeout_ms=timeout_ms)
        .writeStream.format("parquet")
        .option("path", f"{base}/rows")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(**_trigger(interval))
    )
    with _settings(checked.sparkSession, settings):
        return writer.start()


def read_whole_batches(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(COLUMNS).parquet(f"{target.rstrip('/')}/rows")


def open_store(spark: SparkSession, target: str, **options) -> StateStore:
    return StateStore(spark, f"{target.rstrip('/')}/state", **options)


def finish(query: StreamingQuery, target: str, snapshot: str) -> int:
    """Wait until a stream has ended and save the final snapshot."""
    query.awaitTermination()
    return save_snapshot(open_store(SparkSession.active(), target).read(), snapshot)
