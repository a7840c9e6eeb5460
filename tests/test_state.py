"""Folds, merges, lookups, listings, snapshots and identifiers."""

import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

import tallymark as tm
from tallymark.operators.fold import fold_state
from tallymark.operators.validate import batch_verdicts, drop_rejected_batches
from tallymark.streaming.store import StateStore

UPDATE = "seq bigint, type string, name string, value double, delta bigint"
STATE = "type string, name string, value double, delta bigint"
SNAPSHOT = "pos int, id string, type string, value double, delta bigint"


def updates(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], UPDATE)


def gauge(name, value):
    return ("gauge", name, float(value), None)


def counter(name, delta):
    return ("counter", name, None, delta)


def state_of(df):
    return {(r.type, r.name): r.value if r.type == "gauge" else r.delta for r in df.collect()}


def test_fold_keeps_last_gauge_and_adds_counters(spark):
    rows = updates(spark, counter("PollCount", 3), gauge("Alloc", 10), counter("PollCount", 5), gauge("Alloc", 20))
    assert state_of(tm.fold_state(rows)) == {("gauge", "Alloc"): 20.0, ("counter", "PollCount"): 8}


def test_kinds_are_separate_namespaces(spark):
    rows = updates(spark, gauge("x", 1), counter("x", 2))
    assert state_of(tm.fold_state(rows)) == {("gauge", "x"): 1.0, ("counter", "x"): 2}


def test_only_order_matters_not_row_layout(spark):
    rng = random.Random(3)
    log = [gauge(f"g{rng.randrange(5)}", i) if rng.random() < 0.5 else counter(f"c{rng.randrange(5)}", i) for i in range(300)]
    want = {}
    for kind, name, value, delta in log:
        want[kind, name] = value if kind == "gauge" else want.get((kind, name), 0) + delta
    rows = updates(spark, *log)
    assert state_of(tm.fold_state(rows.repartition(7).orderBy(F.rand(1)))) == want
    # Any split into consecutive batches gives the same state.
    state = spark.createDataFrame([], STATE)
    for start, stop in ((0, 17), (17, 17), (17, 180), (180, 300)):
        state = tm.upsert(state, rows.where(f"seq >= {start} AND seq < {stop}"))
    assert state_of(state) == want
    gauges = {r.name: r.value for r in tm.fold_gauges(rows).collect()}
    counters = {r.name: r.delta for r in tm.fold_counters(rows).collect()}
    assert gauges | counters == {name: v for (_, name), v in want.items()}


def test_counter_overflow(spark):
    rows = updates(spark, counter("c", 2**63 - 1), counter("c", 1))
    with pytest.raises(Exception, match="counter overflow"):
        tm.fold_state(rows).collect()
    assert state_of(tm.fold_state(rows, overflow="wrap")) == {("counter", "c"): -(2**63)}
    with pytest.raises(ValueError):
        tm.fold_state(rows, overflow="clip")


def test_fold_times(spark):
    rows = updates(spark, gauge("a", 1), gauge("a", 2)).withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(seq)"))
    row = fold_state(rows, ts="ts").first()
    assert (row.created_at.day, row.updated_at.day) == (1, 2)


def test_ids(spark):
    rows = updates(spark, gauge("a", 1), gauge("a", 2), counter("c", 1), counter("c", 1)).withColumn("id", F.concat(F.lit("i"), F.col("seq")))
    ids = lambda **o: {r.name: r.id for r in tm.fold_ids(rows, **o).collect()}
    assert ids() == {"a": "i0", "c": "i2"}
    assert ids(gauge_id="last") == {"a": "i1", "c": "i2"}


def test_assigned_ids_are_version_7_and_stable(spark):
    rows = spark.range(5000).select(F.col("id").alias("seq"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id)").alias("ts"))
    first = {r.seq: r.id for r in tm.assign_ids(rows).collect()}
    assert len(set(first.values())) == 5000
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", i) for i in first.values())
    assert [first[s][:13] for s in sorted(first)] == sorted(i[:13] for i in first.values())
    assert first == {r.seq: r.id for r in tm.assign_ids(rows.repartition(3)).collect()}


def test_latest_rows(spark):
    rows = updates(spark, gauge("a", 1), gauge("a", 2), counter("c", 5)).withColumn("note", F.concat(F.lit("n"), F.col("seq")))
    assert {(r.name, r.seq, r.note) for r in tm.latest_rows(rows).collect()} == {("a", 1, "n1"), ("c", 2, "n2")}


def test_pack_order_sorts_and_guards(spark):
    rows = spark.createDataFrame([(-1, 5), (0, 1), (0, 2), (1, 0), (2**28, 0), (2**40, 3), (1_700_000_000_000, 2**31 - 1), (2**63 - 1, 3)], "b bigint, p int")
    packed = [r[0] for r in rows.select(tm.pack_order(F.col("b"), F.col("p"))).collect()]
    assert packed == sorted(packed)
    for odd in ((0, 2**31), (0, -1), (None, 0), (0, None)):
        with pytest.raises(Exception, match="out of range"):
            spark.createDataFrame([odd], "b bigint, p bigint").select(tm.pack_order(F.col("b"), F.col("p"))).collect()


def test_merges_keep_packed_orders_of_any_batch(spark):
    rows = [(b, p, "gauge", "a", float(v), None) for b, p, v in ((1_700_000_000_000, 1, 2), (1_700_000_000_000, 0, 1), (-(2**63), 5, 0))]
    new = spark.createDataFrame(rows, "batch_id bigint, pos int, " + STATE).withColumn("seq", tm.pack_order(F.col("batch_id"), F.col("pos")))
    state = spark.createDataFrame([("gauge", "a", 9.0, None), ("counter", "c", None, 3)], STATE)
    low = new.where("batch_id < 0")
    snapshot = new.withColumnRenamed("name", "id")
    for merged in (tm.upsert(state, new), tm.replace(state, new, "seq"), tm.merge_add(state, snapshot, "seq"), tm.restore(state, snapshot, "seq")):
        assert {(r.name, r.value, r.delta) for r in merged.collect()} == {("a", 2.0, None), ("c", None, 3)}
    assert {(r.name, r.value) for r in tm.upsert(state, low).collect()} == {("a", 0.0), ("c", None)}


def test_a_gauge_without_an_order_fails(spark):
    rows = updates(spark, gauge("a", 1), counter("c", 5)).withColumn("seq", F.when(F.col("type") == "counter", F.col("seq")))
    for fold in (tm.fold_state, tm.fold_gauges):
        with pytest.raises(Exception, match="without an order"):
            fold(rows).collect()


@pytest.mark.parametrize("batch", [1, 2**28, 2**40, 1_700_000_000_000])
def test_verdicts_hold_for_any_order(spark, batch):
    rows = spark.createDataFrame([(batch, 0, "name_empty"), (batch, 1, "unsupported_type"), (batch, 2, "value_required"), (batch + 1, 0, None), (None, 0, "name_empty")], "batch_id bigint, pos int, error string")
    ordered = rows.withColumn("seq", tm.pack_order(F.coalesce("batch_id", F.lit(0)), F.col("pos")))
    verdicts = batch_verdicts(ordered)
    assert {r.batch_id: r.error for r in verdicts.collect()} == {batch: "unsupported_type", batch + 1: None, None: "name_empty"}
    assert "SortAggregate" not in verdicts._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_batch_stand_alone(spark):
    rows = spark.createDataFrame([(None, "x", "bad"), (None, "y", None), (1, "a", None), (1, "b", "bad"), (2, "c", None)], "batch_id bigint, name string, error string")
    assert sorted(r.name for r in drop_rejected_batches(rows).collect()) == ["c", "y"]


def test_store_survives_dynamic_overwrite_and_stays_small(spark, tmp_path):
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store = StateStore(spark, str(tmp_path), compact_every=3)
        rows = updates(spark, gauge("a", 1), counter("c", 5)).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")).coalesce(1)
        for epoch in range(14):
            assert store.apply(rows, epoch) and store.applied() == epoch
        assert not store.apply(rows, 13)
        assert {(r.name, r.value, r.delta) for r in store.read().collect()} == {("a", 1.0, None), ("c", None, 70)}
        assert len(list(tmp_path.glob("*/version=*"))) <= 2 + 2 * 3
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)


def test_unknown_readings_are_an_error(spark):
    rows = spark.createDataFrame([(1, 2.0, 3.0)], "poll_id int, Alloc double, Bogus double")
    with pytest.raises(ValueError, match="Bogus"):
        tm.collect_samples(rows, ids=("poll_id",))
    own = spark.createDataFrame([(1, 2.0, 0.25)], "poll_id int, Alloc double, RandomValue double")
    got = {r.name: r.value for r in tm.collect_samples(own, ids=("poll_id",)).collect()}
    assert got == {"Alloc": 2.0, "RandomValue": 0.25, "PollCount": None}


def test_merges(spark):
    state = spark.createDataFrame([gauge("Alloc", 10), counter("PollCount", 3), gauge("old", 1)], STATE)
    batch = updates(spark, gauge("Alloc", 20), counter("PollCount", 5), counter("new", 1))
    kept = {("gauge", "old"): 1.0, ("gauge", "Alloc"): 20.0, ("counter", "new"): 1}
    assert state_of(tm.upsert(state, batch)) == kept | {("counter", "PollCount"): 8}
    assert state_of(tm.replace(state, batch)) == kept | {("counter", "PollCount"): 5}
    snapshot = tm.to_snapshot(batch)
    assert state_of(tm.merge_add(state, snapshot)) == kept | {("counter", "PollCount"): 8}
    assert state_of(tm.upsert(state, batch.limit(0))) == state_of(state)


def test_restore_replays_in_order_and_aborts_on_a_bad_row(spark):
    state = spark.createDataFrame([counter("c", 3), gauge("g", 1)], STATE)
    good = spark.createDataFrame([(0, "c", "counter", None, 5), (1, "c", "counter", None, 2)], SNAPSHOT)
    assert state_of(tm.restore(state, good, "pos")) == {("counter", "c"): 2, ("gauge", "g"): 1.0}
    bad = spark.createDataFrame([(0, "c", "counter", 1.0, 5)], SNAPSHOT)
    with pytest.raises(Exception, match="operand_mismatch"):
        tm.restore(state, bad, "pos").collect()


def test_rename(spark):
    state = spark.createDataFrame([counter("c", 3), gauge("c", 1), gauge("g", 2)], STATE)
    mapping = lambda *rows: spark.createDataFrame(rows, "type string, old string, new string")
    renamed = tm.rename(state, mapping(("gauge", "c", "d"), ("gauge", "missing", "e")))
    assert state_of(renamed) == {("counter", "c"): 3, ("gauge", "d"): 1.0, ("gauge", "g"): 2.0}
    with pytest.raises(Exception, match="name is taken"):
        tm.rename(state, mapping(("gauge", "c", "g"))).collect()
    with pytest.raises(Exception, match="name_empty"):
        tm.rename(state, mapping(("gauge", "c", ""))).collect()


def test_key_violations(spark):
    rows = updates(spark, gauge("a", 1), gauge("a", 2), counter("a", 1))
    assert [(r.type, r.name, r.n) for r in tm.key_violations(rows).collect()] == [("gauge", "a", 2)]


def test_listing(spark):
    state = spark.createDataFrame([gauge("HeapAlloc", 123.45), counter("PollCount", 7), gauge("<b>", math.inf), gauge("Z", 1), gauge("a", 1e21)], STATE)
    rows = [tuple(r) for r in tm.list_state(state).collect()]
    assert rows == [
        ("counter", "PollCount", "7"), ("gauge", "<b>", "+Inf"), ("gauge", "HeapAlloc", "123.45"), ("gauge", "Z", "1"),
        ("gauge", "a", "1" + "0" * 21),
    ]
    lines = [r.line for r in tm.render_list(state).collect()]
    assert lines[:2] == ["counter PollCount = 7", "gauge &lt;b&gt; = &#43;Inf"]
    assert [r.name for r in tm.list_gauges(state).collect()] == ["<b>", "HeapAlloc", "Z", "a"]
    assert [tuple(r) for r in tm.list_counters(state).collect()] == [("PollCount", 7)]


def test_lookups(spark):
    state = spark.createDataFrame([gauge("Alloc", 123.45), counter("PollCount", 7)], STATE)
    asked = [("gauge", "Alloc"), ("counter", "PollCount"), ("gauge", "Missing"), ("hist", "Alloc"), ("gauge", ""), ("gauge", "Alloc")]
    requests = spark.createDataFrame(asked, "type string, name string")
    got = sorted(str((r.type, r.name, r.value, r.error, r.status)) for r in tm.lookup_many(state, requests).collect())
    alloc = ("gauge", "Alloc", "123.45", None, 200)
    want = [
        alloc, alloc, ("counter", "PollCount", "7", None, 200), ("gauge", "Missing", None, "not_found", 404),
        ("hist", "Alloc", None, "unsupported_type", 400), ("gauge", "", None, "not_found", 404),
    ]
    assert got == sorted(map(str, want))
    typed = {(r.name, r.value, r.delta) for r in tm.lookup_typed(state, requests).where("error IS NULL").collect()}
    assert typed == {("Alloc", 123.45, None), ("PollCount", None, 7)}
    assert [r.value for r in tm.lookup_point(state, "gauge", "Alloc").collect()] == [123.45]


def test_snapshot_round_trip(spark, tmp_path):
    path = str(tmp_path / "deep" / "snapshots")
    state = spark.createDataFrame([gauge("Alloc", 12.3), counter("PollCount", 7)], STATE)
    assert tm.load_snapshot(spark, path).count() == 0
    assert tm.save_snapshot(state, path) == 1
    loaded = tm.load_snapshot(spark, path)
    assert {(r.id, r.type, r.value, r.delta) for r in loaded.collect()} == {("Alloc", "gauge", 12.3, None), ("PollCount", "counter", None, 7)}
    assert state_of(tm.restore(spark.createDataFrame([], STATE), loaded, "pos")) == state_of(state)
    assert tm.save_snapshot(state.limit(0), path) == 2
    assert tm.load_snapshot(spark, path).count() == 0


def test_failed_save_keeps_the_version_before(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    tm.save_snapshot(spark.createDataFrame([gauge("a", 1)], STATE), path)
    for bad in (gauge("broken", math.nan), ("gauge", "", 1.0, None), ("x", "a", 1.0, None)):
        with pytest.raises(Exception, match="not_finite at broken|id_empty|unsupported_type"):
            tm.save_snapshot(spark.createDataFrame([bad], STATE), path)
        assert [r.id for r in tm.load_snapshot(spark, path).collect()] == ["a"]
    with pytest.raises(ValueError):
        tm.save_snapshot(spark.createDataFrame([], STATE), "  ")


def test_array_files(spark, tmp_path):
    file = tmp_path / "state.json"
    load = lambda text: (file.write_text(text), tm.load_snapshot(spark, str(file)).orderBy("pos").collect())[1]
    rows = [{"id": "a", "type": "counter", "delta": 1}, {"id": "b", "type": "gauge", "value": 2.5}, {"id": "a", "type": "counter", "delta": 3}]
    assert [(r.pos, r.id, r.value, r.delta) for r in load(json.dumps(rows, indent=2))] == [(0, "a", None, 1), (1, "b", 2.5, None), (2, "a", None, 3)]
    for empty in ("", "null\n", "[]"):
        assert load(empty) == []
    broken = ('[{"id":"a"', '[{"id":"a","type":"gauge","value":1,"x":1}]', '[{"id":"","type":"gauge","value":1}]',
              '[{"id":"a","type":"gauge"}]', '[{"id":"a","type":"unknown","value":1}]', '{"id":"a","type":"gauge","value":1}')
    for text in broken:
        with pytest.raises(Exception, match="invalid snapshot row"):
            load(text)
