"""Streams equal their batch twins, and replays change nothing."""

import pytest
from pyspark.sql import functions as F

import tallymark as tm
from tallymark.streaming.store import StateStore

UPDATE = "seq bigint, ts timestamp_ntz, type string, name string, value double, delta bigint"
COLUMNS = ("type", "name", "value", "delta")


def state_of(df):
    return {tuple(r) for r in df.select(*COLUMNS).collect()}


@pytest.fixture(scope="module")
def log(spark):
    return spark.range(900).select(
        F.col("id").alias("seq"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        F.when(F.col("id") % 2 == 0, "gauge").otherwise("counter").alias("type"),
        F.concat(F.lit("m"), F.col("id") % 7).alias("name"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("value"),
        F.when(F.col("id") % 2 == 1, F.col("id")).alias("delta"),
    )


def test_store_applies_epochs_once(spark, log, tmp_path):
    store = StateStore(spark, str(tmp_path), compact_every=2)
    assert store.applied() == -1 and store.read().count() == 0
    for epoch in range(5):
        rows = log.where(f"seq >= {epoch * 180} AND seq < {epoch * 180 + 180}")
        assert store.apply(rows, epoch)
        assert not store.apply(rows, epoch)
    assert store.full.complete() == [1, 3]
    assert state_of(store.read()) == state_of(tm.fold_state(log))
    store.compact()
    assert store.full.complete()[-1] == 4
    assert state_of(store.read()) == state_of(tm.fold_state(log))
    store.expire(keep=1)
    assert store.full.complete() == [4] and store.deltas.complete() == []
    assert state_of(store.read()) == state_of(tm.fold_state(log))
    times = store.read().agg(F.min("created_at"), F.max("updated_at")).first()
    assert times == log.agg(F.min("ts"), F.max("ts")).first()


def test_an_unfinished_epoch_is_not_seen_and_is_redone(spark, log, tmp_path):
    store = StateStore(spark, str(tmp_path))
    store.apply(log.where("seq < 100"), 0)
    before = state_of(store.read())
    store.deltas.write(log.where("seq >= 100").drop("seq", "ts").withColumns({"created_at": F.lit(None), "updated_at": F.lit(None)}), 1, ("type",))
    (tmp_path / "delta" / "version=1" / "_SUCCESS").unlink()
    assert state_of(store.read()) == before
    assert store.apply(log.where("seq >= 100"), 1)
    assert state_of(store.read()) == state_of(tm.fold_state(log))


def test_point_lookup_conditions_reach_the_scan(spark, log, tmp_path):
    store = StateStore(spark, str(tmp_path))
    store.apply(log, 0)
    plan = tm.lookup_point(store.read(), "gauge", "m2")._jdf.queryExecution().toString()
    assert "EqualTo(name,m2)" in plan and "PartitionFilters: [isnotnull(type" in plan


def test_stream_fold_equals_batch_fold(spark, log, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    log.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = tm.run_fold(stream, target, state_partitions=2)
    query.awaitTermination()
    assert query.lastProgress.batchId == 2 and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert state_of(tm.read_fold(spark, target)) == state_of(tm.fold_state(log))


@pytest.mark.parametrize("order", ["bigint", "decimal(38,0)"])
def test_state_of_a_running_fold_without_a_copy(spark, log, tmp_path, order):
    source, target, saved = (str(tmp_path / d) for d in ("in", "out", "snapshots"))
    updates = log.withColumn("seq", F.col("seq").cast(order))

    def arrive(rows, **options):
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(updates.schema).parquet(source)
        tm.run_fold(stream, target, state_partitions=2, copy=False, **options).awaitTermination()

    arrive(updates.where("seq < 450"))
    arrive(updates.where("seq >= 450"))
    assert state_of(tm.read_running(spark, target)) == state_of(tm.fold_state(updates))
    assert state_of(tm.read_running(spark, target, 0)) == state_of(tm.fold_state(updates.where("seq < 450")))
    times = tm.read_running(spark, target).agg(F.min("created_at"), F.max("updated_at")).first()
    assert times == log.agg(F.min("ts"), F.max("ts")).first()
    assert not (tmp_path / "out" / "state").exists()
    # a snapshot counts for new targets only
    tm.save_snapshot(tm.fold_state(log), saved)
    arrive(updates.limit(0), snapshot=saved)
    assert state_of(tm.read_running(spark, target)) == state_of(tm.fold_state(updates))
    target = str(tmp_path / "other")
    arrive(updates.limit(0), snapshot=saved)
    twice = tm.fold_state(log).withColumn("delta", F.col("delta") * 2)
    assert state_of(tm.read_running(spark, target)) == state_of(twice)


DOCS = [
    '[{"id":"g","type":"gauge","value":1},{"id":"c","type":"counter","delta":2},{"id":"c","type":"counter","delta":3}]',
    '[{"id":"c","type":"counter","delta":100},{"id":"","type":"gauge","value":1}]',
    "[]", "null", "broken",
    '[{"id":"g","type":"gauge","value":5},{"id":"g","type":"gauge","value":4}]',
]


def deliver(spark, folder, docs, first):
    rows = [(first + i, d) for i, d in enumerate(docs)]
    frame = spark.createDataFrame(rows, "batch_id bigint, doc string").withColumn("ts", F.expr("timestamp_ntz'2024-01-01'"))
    frame.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(frame.schema).parquet(folder)


def test_upsert_stream(spark, tmp_path):
    folder, target, saved = (str(tmp_path / d) for d in ("in", "out", "snapshots"))
    refused = []
    options = dict(interval=None, snapshot=saved, sync=True, rejects=lambda rows, epoch: refused.extend(r.error for r in rows.collect()))
    stream = deliver(spark, folder, DOCS, 0)
    tm.run_upsert(stream, target, **options).awaitTermination()
    want = {("gauge", "g", 4.0, None), ("counter", "c", None, 5)}
    assert state_of(tm.open_store(spark, target).read()) == want
    assert sorted(refused) == ["malformed_json", "name_empty", "name_empty"]
    # A restart without new input changes nothing; new input adds to what is there.
    tm.run_upsert(stream, target, interval=None).awaitTermination()
    assert state_of(tm.open_store(spark, target).read()) == want
    stream = deliver(spark, folder, [DOCS[0]], 10)
    version = tm.finish(tm.run_upsert(stream, target, **options), target, saved)
    assert version == 3
    snapshot = {(r.id, r.value, r.delta) for r in tm.load_snapshot(spark, saved).collect()}
    assert snapshot == {("g", 1.0, None), ("c", None, 10)}
    # A new store starts from the snapshot.
    other_in, other = str(tmp_path / "in2"), str(tmp_path / "out2")
    stream = deliver(spark, other_in, ['[{"id":"c","type":"counter","delta":1}]'], 0)
    tm.run_upsert(stream, other, interval=None, snapshot=saved).awaitTermination()
    assert state_of(tm.open_store(spark, other).read()) == {("gauge", "g", 1.0, None), ("counter", "c", None, 11)}


def test_a_failing_snapshot_does_not_stop_the_stream(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    stream = deliver(spark, str(tmp_path / "in"), DOCS[:1], 0)
    target = str(tmp_path / "out")
    tm.run_upsert(stream, target, interval=None, snapshot=str(blocked), sync=True, restore=False).awaitTermination()
    assert state_of(tm.open_store(spark, target).read()) == {("gauge", "g", 1.0, None), ("counter", "c", None, 5)}


def test_interval_fold_streams_with_a_watermark(spark, log, tmp_path):
    source = str(tmp_path / "in")
    log.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(log.schema).parquet(source)
    folded = tm.interval_fold(stream, "1 minute", watermark="10 seconds")
    query = folded.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    minutes = lambda df: {tuple(r) for r in df.select(F.date_format("start", "HH:mm"), *COLUMNS).collect()}
    closed = minutes(spark.read.parquet(str(tmp_path / "out")))
    whole = minutes(tm.interval_fold(log, "1 minute"))
    assert closed and closed <= whole
