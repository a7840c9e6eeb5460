"""Array snapshots in parallel, the relational table, batches on streams, restored folds, ids and running totals."""

import json
import math
import random
import sqlite3
import time

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

import tallymark as tm
from tallymark.functions.uuids import uuid_high, uuid_low, uuid_text
from tallymark.operators import report
from tallymark.operators.validate import drop_rejected_batches
from tallymark.sources import metric_table
from tallymark.sources.arrays import pieces
from tallymark.sources.snapshots import decode_array, decode_snapshot
from tallymark.streaming import batches

UPDATE = "seq bigint, type string, name string, value double, delta bigint"
STATE = "type string, name string, value double, delta bigint"
COLUMNS = ("type", "name", "value", "delta")


def updates(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], UPDATE)


def gauge(name, value):
    return ("gauge", name, float(value), None)


def counter(name, delta):
    return ("counter", name, None, delta)


def plain(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


# --- running totals


def test_running_totals_cross_buckets(spark, monkeypatch):
    monkeypatch.setattr(report, "BUCKET_TICKS", 4)
    rng = random.Random(2)
    log = [(rng.randrange(1, 60), *(gauge(f"g{rng.randrange(3)}", i) if rng.random() < 0.4 else counter("hot", rng.randrange(-9, 9)))) for i in range(400)]
    log.sort(key=lambda r: r[0])  # later updates are shipped later
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(log)], "seq bigint, tick bigint, " + STATE)
    want = {}
    for last in range(1, 61):
        for tick, kind, name, value, delta in log:
            if tick <= last:
                want[last, kind, name] = value if kind == "gauge" else want.get((last, kind, name), 0) + delta
    shipped = lambda df: {(r.tick, r.type, r.name): r.value if r.type == "gauge" else r.delta for r in df.collect()}
    assert shipped(tm.report_cumulative(rows, last_tick=F.lit(60))) == want
    some = tm.report_cumulative(rows, first_tick=F.lit(17), last_tick=F.lit(23))
    assert shipped(some) == {k: v for k, v in want.items() if 17 <= k[0] <= 23}
    changes = tm.report_changes(rows).orderBy("type", "name", "tick").collect()
    for a, b in zip(changes, changes[1:], strict=False):
        assert a.next_tick == (b.tick if (a.type, a.name) == (b.type, b.name) else None)
    assert tm.report_changes(rows.limit(0)).collect() == []


def test_no_window_holds_the_changes_of_a_key(spark):
    rows = spark.createDataFrame([(1, 1, "counter", "c", None, 1)], "seq bigint, tick bigint, " + STATE)
    plan = tm.report_changes(rows)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    by_key = [line for line in windows if line.rstrip().split("], [")[1].count("#") == 2]
    assert len(windows) >= 2 and all("first" in line for line in by_key)  # by key alone: only the totals of buckets


def test_reports_do_not_wrap_silently(spark):
    rows = spark.createDataFrame([(i, i + 1, "counter", "c", None, 2**62) for i in range(4)], "seq bigint, tick bigint, " + STATE)
    for made in (tm.report_changes, tm.report_overcount):
        with pytest.raises(Exception, match="counter overflow"):
            made(rows).collect()
    assert sorted(r.delta for r in tm.report_changes(rows, overflow="wrap").collect()) == [-(2**63), -(2**62), 0, 2**62]
    assert tm.report_overcount(rows, overflow="wrap").first().delta == (10 * 2**62 + 2**63) % 2**64 - 2**63
    timed = rows.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    with pytest.raises(Exception, match="counter overflow"):
        tm.interval_fold(timed, "1 day").collect()


# --- merges, ids and times


def test_merges_fail_where_the_winner_is_unknown(spark):
    state = spark.createDataFrame([gauge("g", 1), counter("c", 2)], STATE)
    twice = spark.createDataFrame([gauge("g", 2), gauge("g", 3)], STATE)
    for merge in (tm.replace, tm.merge_add):
        with pytest.raises(Exception, match="key occurs twice"):
            merge(state, twice).collect()
    two = spark.createDataFrame([counter("c", 2), counter("c", 3)], STATE)
    assert plain(tm.merge_add(state, two)) == sorted([counter("c", 7), gauge("g", 1)], key=str)
    with pytest.raises(Exception, match="key occurs twice"):
        tm.replace(state, two).collect()
    lost = spark.createDataFrame([(*gauge("new", 5), None), (*counter("c", 9), 1)], STATE + ", pos int")
    with pytest.raises(Exception, match="without an order"):
        tm.replace(state, lost, "pos").collect()
    with pytest.raises(Exception, match="without an order"):
        tm.restore(state, lost.withColumnRenamed("name", "id"), "pos").collect()
    assert plain(tm.replace(state, lost.where("pos = 1"), "pos")) == sorted([gauge("g", 1), counter("c", 9)], key=str)


def test_uuids_round_trip(spark):
    texts = ["00000000-0000-0000-0000-000000000000", "ffffffff-ffff-ffff-ffff-ffffffffffff", "01890a5d-ac96-774b-bcce-b302099a8057", "80000000-0000-0000-8000-000000000001", None]
    df = spark.createDataFrame([(t,) for t in texts], "id string")
    back = df.select(uuid_text(uuid_high(F.col("id")), uuid_low(F.col("id"))).alias("id"))
    assert [r.id for r in back.collect()][:4] == texts[:4]
    upper = spark.createDataFrame([(texts[2].upper(),)], "id string")
    assert upper.select(uuid_text(uuid_high(F.col("id")), uuid_low(F.col("id")))).first()[0] == texts[2]
    with pytest.raises(Exception, match="not a UUID"):
        spark.createDataFrame([("i7",)], "id string").select(uuid_high(F.col("id"))).collect()


def test_ids_and_times_survive_merges(spark):
    log = updates(spark, gauge("g", 1), counter("c", 1), gauge("g", 2), counter("c", 1), gauge("h", 3))
    log = tm.assign_ids(log.withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(seq)")))
    given = {r.seq: r.id for r in log.collect()}
    old, new = log.where("seq < 2"), log.where("seq >= 2")
    for ids, want in (("first", {"g": 0, "c": 1, "h": 4}), ("last", {"g": 2, "c": 1, "h": 4})):
        state = tm.upsert(tm.fold_state(old, ts="ts", ids=ids), new, ts="ts", ids=ids)
        rows = {r["name"]: r for r in state.collect()}
        assert {n: r.id for n, r in rows.items()} == {n: given[s] for n, s in want.items()}
        assert {n: (r.created_at.day, r.updated_at.day) for n, r in rows.items()} == {"g": (1, 3), "c": (2, 4), "h": (5, 5)}
        assert {r["name"]: r.id for r in tm.fold_uuids(log, ids=ids).collect()} == {n: given[s] for n, s in want.items()}
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    now = F.lit("2024-06-01").cast("timestamp_ntz")
    merged = {r["name"]: r for r in tm.replace(state, new.where("seq = 4"), ts=now, ids="first").collect()}
    assert (merged["h"].created_at.month, merged["h"].updated_at.month, merged["g"].updated_at.month) == (1, 6, 1)
    added = {r["name"]: r for r in tm.merge_add(state, tm.to_snapshot(new.where("seq = 3")), ts=now).collect()}
    assert (added["c"].delta, added["c"].created_at.day, added["c"].updated_at.month) == (3, 2, 6)


# --- JSON lookups


def test_json_lookup_answers(spark):
    state = spark.createDataFrame([gauge("g", 1.5), counter("c", 2), gauge("nan", math.nan)], STATE)
    docs = ['{"id":"g","type":"gauge"}', '{"id":"c","type":"counter"}', '{"id":"c","type":"gauge"}', '{"id":"","type":"gauge"}', '{"id":"g","type":"x"}', '{"id":"g"', '{"id":"nan","type":"gauge"}']
    asked = tm.decode_lookups(spark.createDataFrame(list(enumerate(docs)), "seq bigint, doc string"))
    got = [(r.payload and json.loads(r.payload), r.error, r.status) for r in tm.lookup_json(state, asked).orderBy("seq").collect()]
    assert got == [
        ({"id": "g", "type": "gauge", "value": 1.5}, None, 200), ({"id": "c", "type": "counter", "delta": 2}, None, 200),
        (None, "not_found", 404), (None, "name_empty", 400), (None, "unsupported_type", 400), (None, "malformed_json", 400), (None, "not_finite", 500),
    ]


# --- array snapshots


ODD = [
    "", "  \n", "null", " null ", "[]", " [ \n ] ", "[] tail", '[{"id":"a","type":"gauge","value":1}]', '[{"id":"a","type":"gauge","value":1}] and {more} ["]',
    '[{"id":"}{\\"][,","type":"gauge","value":1},{"id":"\\\\","type":"counter","delta":7}]', '\n[\n  {\n "id" : "a}" ,"type":"gauge","value":-1e3 }\n ,\n{"type":"counter","id":"b","delta":0}\n]\n',
    '[{"id":"a","type":"gauge","value":1}', '[{"id":"a","type":"gauge","value":1},]', '[{"id":"a","type":"gauge","value":1} {"id":"b","type":"gauge","value":1}]', '{"id":"a","type":"gauge","value":1}',
    '[{"id":"a","type":"gauge","value":1,"x":{"y":[1]}}]', '[[{"id":"a","type":"gauge","value":1}]]', "[1]", "[null]", '["}"]', '[{"id":"a","type":"gauge","value":1},5]', "}", "]", "[", '[{"id":"',
    '[{"id":"a","type":"gauge"}]', '[{"id":"","type":"gauge","value":1}]', '[{"id":"é}中","type":"counter","delta":9223372036854775807}]', '[{"id":"a","type":"gauge","value":"1"}]', '[,{"id":"a","type":"gauge","value":1}]',
]


def read_or_error(df):
    try:
        return sorted(map(tuple, df.collect()))
    except Exception as error:
        assert "invalid snapshot row" in str(error)
        return "refused"


def test_arrays_read_in_pieces_as_in_one(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9b")
    try:
        for i, doc in enumerate(ODD[:13:2] + ODD[9:30:3]):
            (tmp_path / f"{i}.json").write_text(doc, encoding="utf-8")
            whole = decode_snapshot(spark.createDataFrame([(doc,)], "value string"), True)
            assert (doc, read_or_error(decode_array(spark, [str(tmp_path / f"{i}.json")]))) == (doc, read_or_error(whole))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_large_array_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    name = lambda i: f"n{i}" + "".join(rng.choices('{}[]",\\é ', k=rng.randrange(8)))
    rows = [{"id": name(i), "type": "gauge", "value": i + 0.5} if i % 2 else {"id": name(i), "type": "counter", "delta": -i} for i in range(20_000)]
    path = tmp_path / "one.json"
    path.write_text(json.dumps(rows))  # one line
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        assert pieces(spark, [str(path)]).rdd.getNumPartitions() > 5
        got = tm.load_snapshot(spark, str(path)).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.pos, r.id, r.type, r.value, r.delta) for r in got] == [(i, m["id"], m["type"], m.get("value"), m.get("delta")) for i, m in enumerate(rows)]


def test_arrays_are_written_in_parts(spark, tmp_path):
    state = spark.createDataFrame([gauge(f'g{i}"\\\n<é', i / 7) for i in range(200)] + [counter(f"c{i}", -i) for i in range(200)], STATE).repartition(6)
    folder, one = str(tmp_path / "parts"), str(tmp_path / "one.json")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tm.save_array(state, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "parts").glob("part-*"))) > 1
    want = sorted(state.collect(), key=lambda r: (r.type, r["name"].encode()))
    want = [(i, r["name"], r.type, r.value, r.delta) for i, r in enumerate(want)]
    assert [tuple(r) for r in tm.load_snapshot(spark, folder).orderBy("pos").collect()] == want
    tm.join_parts(spark, folder, one)
    text = (tmp_path / "one.json").read_text(encoding="utf-8")
    metrics = json.loads(text)
    assert [(i, m["id"], m["type"], m.get("value"), m.get("delta")) for i, m in enumerate(metrics)] == want
    assert text == json.dumps(metrics, indent=2, ensure_ascii=False) + "\n"
    assert [tuple(r) for r in tm.load_snapshot(spark, one).orderBy("pos").collect()] == want
    tm.save_array(state.limit(0), folder)
    assert tm.load_snapshot(spark, folder).collect() == []
    tm.join_parts(spark, folder, one)
    assert (tmp_path / "one.json").read_text() == "[]\n"
    with pytest.raises(Exception, match="not_finite"):
        tm.save_array(spark.createDataFrame([gauge("g", math.inf)], STATE), folder)
    assert tm.load_snapshot(spark, folder).collect() == []


# --- the relational table


@pytest.fixture
def table(spark, tmp_path):
    tm.register_table(spark)
    return {"database": str(tmp_path / "metrics.db"), "table": "metric"}


def stored(spark, table, **options):
    return spark.read.format("metric_table").options(**table, **options).load()


def test_the_table_round_trip(spark, table):
    log = updates(spark, *[gauge(f"g{i % 30}", i) if i % 2 else counter(f"c{i % 40}", i) for i in range(2000)])
    old, new = log.where("seq < 900"), log.where("seq >= 900")
    for rows in (old, new):
        rows.repartition(5).write.format("metric_table").options(**table).mode("append").save()
    want = plain(tm.fold_state(log))
    assert plain(stored(spark, table)) == want
    for ranges in ("1", "3", "1000"):
        parts = stored(spark, table, ranges=ranges)
        assert plain(parts) == want and parts.rdd.getNumPartitions() == min(int(ranges), len(want))
    rows = stored(spark, table).collect()
    assert len({r.id for r in rows}) == len(rows) and all(r.created_at <= r.updated_at for r in rows)
    new.write.format("metric_table").options(**table, add="false").mode("append").save()
    assert {r["name"]: r.delta for r in stored(spark, table).where("type = 'counter'").collect()}["c38"] == 1998
    with sqlite3.connect(table["database"]) as db:
        assert db.execute("SELECT count(*) FROM metric_incoming").fetchone() == (0,)
    with pytest.raises(Exception, match="use mode append"):
        new.write.format("metric_table").options(**table).mode("overwrite").save()
    with pytest.raises(Exception, match="misses the columns"):
        new.drop("delta").write.format("metric_table").options(**table).mode("append").save()


def test_an_epoch_counts_once(spark, table):
    rows = updates(spark, counter("c", 5))
    for epoch in (3, 3, 4):
        rows.write.format("metric_table").options(**table, stream="s", epoch=str(epoch)).mode("append").save()
    assert plain(stored(spark, table)) == [counter("c", 10)]


def test_a_failed_write_leaves_the_table(spark, table):
    good = updates(spark, counter("c", 5))
    good.write.format("metric_table").options(**table).mode("append").save()
    bad = good.unionByName(updates(spark, ("counter", "c", None, None)).withColumn("name", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        bad.repartition(3).write.format("metric_table").options(**table).mode("append").save()
    assert plain(stored(spark, table)) == [counter("c", 5)]


def test_rows_of_lost_attempts_are_not_merged(tmp_path):
    schema = StructType([StructField(n, StringType()) for n in ("type", "name", "value", "delta")])
    target = metric_table.Table("metric", str(tmp_path / "m.db"), None, "?")
    target.create()
    writer = metric_table.TableStreamWriter(target, schema, "s", True)
    batch = pa.RecordBatch.from_pydict({"type": ["counter"], "name": ["c"], "value": pa.array([None], pa.float64()), "delta": [7]})
    lost, kept = writer.write(iter([batch])), writer.write(iter([batch, batch]))
    committing = metric_table.TableStreamWriter(target, schema, "s", True)  # Spark may commit through another copy
    assert lost.attempt != kept.attempt
    committing.commit([kept], 0)
    again = writer.write(iter([batch]))
    committing.commit([again], 0)  # replayed epoch
    dropped = writer.write(iter([batch]))
    committing.abort([dropped, None], 1)
    rows = lambda sql: sqlite3.connect(target.database).execute(sql).fetchall()
    assert rows("SELECT name, counter_value FROM metric") == [("c", 14)] and rows("SELECT count(*) FROM metric_incoming") == [(0,)]
    assert rows("SELECT * FROM metric_epochs") == [("s", 0)]


def test_a_stream_into_the_table(spark, table, tmp_path):
    log = updates(spark, *[gauge("g", i) if i % 3 else counter(f"c{i % 5}", i) for i in range(300)])
    source = str(tmp_path / "in")
    for lo in (0, 100, 200):
        log.where(f"seq >= {lo} AND seq < {lo + 100}").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).parquet(source)
        query = stream.writeStream.format("metric_table").options(**table, stream="log").option("checkpointLocation", str(tmp_path / "check"))
        query.trigger(availableNow=True).start().awaitTermination()
    assert plain(stored(spark, table)) == plain(tm.fold_state(log))


# --- streams


BATCH = "batch_id bigint, n_items int, seq bigint, type string, name string, value double, delta bigint, error string"


def test_batches_of_a_stream_come_whole_or_not_at_all(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for b in range(40):
        n = rng.randrange(1, 9)
        bad = rng.randrange(3 * n)
        rows += [(b, n, 100 * b + i, *(gauge("g", math.nan if i == 1 else 2**53 + 1.0) if i % 2 else counter("c", 2**53 + 1)), "broken" if i == bad else None) for i in range(n)]
    rows += [(None, None, 9000, *gauge("x", 1), None), (None, None, 9001, *gauge("x", 1), "broken"), (77, 3, 9100, *gauge("x", 1), None)]
    rng.shuffle(rows)
    df, source, target = spark.createDataFrame(rows, BATCH), str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(4):  # every batch is spread over four micro-batches and two runs
        df.where(f"seq % 4 = {k}").coalesce(1).write.mode("append").parquet(source)
        if k % 2:
            stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
            tm.run_whole_batches(stream, target, state_partitions=2).awaitTermination()
    got = tm.read_whole_batches(spark, target)
    # The batch operator judges by the same rule, but does not know that batch 77 is still open.
    want = drop_rejected_batches(df).where("batch_id IS NULL OR batch_id <> 77").select(*got.columns)
    shown = lambda d: sorted(map(str, d.collect()))
    assert shown(got) == shown(want)


def test_large_batches_leave_the_state_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "RELEASE_ROWS", 100)
    df = spark.range(950).select(F.lit(1).cast("bigint").alias("batch_id"), F.lit(950).alias("n_items"), F.col("id").alias("seq"), F.lit("counter").alias("type"), F.lit("c").alias("name"), F.lit(None).cast("double").alias("value"), F.col("id").alias("delta"), F.lit(None).cast("string").alias("error"))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    tm.run_whole_batches(stream, str(tmp_path / "out"), state_partitions=1).awaitTermination()
    assert sorted(r.seq for r in tm.read_whole_batches(spark, str(tmp_path / "out")).collect()) == list(range(950))


def rows_of_batches(spark, ids, k, n):
    """The k-th of the n rows of each batch."""
    return spark.createDataFrame([(b, n, n * b + k, *counter("c", b), "broken" if b % 50 == 49 and k else None) for b in ids], BATCH)


def test_the_state_grows_with_groups_of_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "GROUPS", 8)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    state = []
    for k in range(3):
        rows_of_batches(spark, range(400), k, 3).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(BATCH).parquet(source)
        query = tm.run_whole_batches(stream, target, state_partitions=2)
        query.awaitTermination()
        state.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert 0 < state[0] <= 16 and state[1] <= 24 and state[2] == 0
    got = sorted(r.seq for r in tm.read_whole_batches(spark, target).collect())
    assert got == [3 * b + k for b in range(400) if b % 50 != 49 for k in range(3)]


class Held:
    """Stands in for a group's state, and for its handle."""

    def __init__(self):
        self.rows, self.value, self.timers = {}, None, []
        self.getMapState = self.getValueState = lambda *_: self
        self.listTimers, self.deleteTimer, self.registerTimer = lambda: list(self.timers), self.timers.remove, self.timers.append
        self.exists, self.get, self.clear = lambda: self.value is not None, lambda: self.value, lambda: self.update(None)
        self.getValue, self.removeKey, self.updateValue = self.rows.get, self.rows.pop, self.rows.__setitem__
        self.getCurrentProcessingTimeInMs = self.getExpiryTimeInMs = lambda: self.now

    def update(self, value):
        self.value = value


def test_batches_that_do_not_fill_up_in_time_are_forgotten():
    held = Held()
    assembler = batches.BatchAssembler(["seq"], 100)
    assembler.init(held)

    def come(now, *rows):
        held.now = now
        part = pd.DataFrame([(b, 2, 0, f"{b}{i}") for b, i in rows], columns=["batch_key", "n_items", "bad", "seq"])
        return sorted(x for out in assembler.handleInputRows(1, iter([part]), held) for x in out["seq"])

    assert come(0, ("a", 0), ("b", 0)) == [] and held.timers == [100]
    assert come(50, ("b", 1), ("c", 0)) == ["b0", "b1"] and held.timers == [100]
    held.now = 100
    assert list(assembler.handleExpiredTimer(1, held, held)) == [] and held.timers == [150]
    assert come(120, ("a", 1), ("c", 1)) == ["c0", "c1"] and held.timers == [220]
    held.now = 220
    assert list(assembler.handleExpiredTimer(1, held, held)) == []
    assert not held.timers and not held.rows and held.value is None


def test_a_fold_starts_from_a_snapshot(spark, tmp_path):
    log = updates(spark, gauge("g", 1), counter("c", 1), gauge("old", 9), gauge("g", 2), counter("c", 5), counter("new", 1))
    log = log.withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(seq)"))
    saved, source, target = (str(tmp_path / d) for d in ("saved", "in", "out"))
    tm.save_snapshot(tm.fold_state(log.where("seq < 3")), saved)
    log.where("seq >= 3").coalesce(1).write.parquet(source)
    for _ in range(2):  # a restart does not restore again
        stream = spark.readStream.schema(log.schema).parquet(source)
        tm.run_fold(stream, target, state_partitions=2, snapshot=saved).awaitTermination()
        assert plain(tm.read_fold(spark, target)) == plain(tm.fold_state(log))
        tm.save_snapshot(tm.fold_state(log), saved)


def test_an_idle_stream_still_saves_its_last_change(spark, tmp_path):
    target, saved = str(tmp_path / "out"), str(tmp_path / "saved")
    store = tm.open_store(spark, target)
    timed = lambda *rows: updates(spark, *rows).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    ticks = tm.run_saves(spark, target, saved, every="1 second")
    try:
        for epoch, want in ((0, 1), (1, 3)):
            store.apply(timed(counter("c", epoch + 1)), epoch)
            deadline = time.monotonic() + 90
            while time.monotonic() < deadline and [r.delta for r in tm.load_snapshot(spark, saved).collect()] != [want]:
                time.sleep(0.5)
            assert [(r.id, r.delta) for r in tm.load_snapshot(spark, saved).collect()] == [("c", want)]
        time.sleep(3)
        assert len(list((tmp_path / "saved").glob("version=*"))) == 2  # nothing is saved without a change
    finally:
        ticks.stop()


# --- status in the same pass


def test_violations_are_counted_in_the_pass_that_reads_the_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (2,), (None,), (-4,)], "v int")
    rules = {"missing": F.col("v").isNull(), "negative": F.col("v") < 0, "large": F.col("v") > 9}
    seen = Observation("health")
    tm.observed(rows, rules, seen).write.parquet(str(tmp_path / "rows"))
    assert sorted(map(tuple, tm.observed_report(spark, seen).collect())) == sorted(map(tuple, tm.quality_report(rows, rules).collect()))
    none = Observation("none")
    tm.observed(rows, {}, none).count()
    assert [tuple(r) for r in tm.observed_report(spark, none).collect()] == [("overall", "ok", None)]


def test_a_failing_check_shows_per_micro_batch(spark, tmp_path):
    for values in ([1, 2], [3, -1, -2], [4]):
        spark.createDataFrame([(v,) for v in values], "v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    failed = []
    health = tm.StreamHealth("health", lambda batch, counts: failed.append((batch, counts["negative"])))
    spark.streams.addListener(health)
    try:
        stream = spark.readStream.schema("v int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        writer = tm.observed(stream, {"negative": F.col("v") < 0}, "health").writeStream.format("noop")
        writer.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
        deadline = time.monotonic() + 30
        while time.monotonic() < deadline and len(health.batches) < 3:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(health)
    assert [(b, c["rows_seen"], c["negative"]) for b, c in health.batches] == [(0, 2, 0), (1, 3, 2), (2, 1, 0)] and failed == [(1, 2)]
    report = {r["name"]: r.status for r in tm.counted_report(spark, health.batches[1][1]).collect()}
    assert report == {"negative": "error", "overall": "unhealthy"}
