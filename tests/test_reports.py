"""Samples, ticks, cumulative reports, payloads and the quality report."""

import gzip
import json
import math

import pytest
from pyspark.sql import functions as F

import tallymark as tm
from tallymark import schema as S

TICKED = "seq bigint, tick bigint, type string, name string, value double, delta bigint"


@pytest.fixture(scope="module")
def polls(spark):
    values = [float(i) for i in range(len(S.RUNTIME_NAMES))]
    values[3], values[5] = math.nan, -math.inf
    columns = ", ".join(f"{n} double" for n in S.RUNTIME_NAMES)
    rows = [(p, *values) for p in (1, 2, 3)]
    wide = spark.createDataFrame(rows, f"poll_id bigint, {columns}")
    return wide.withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, poll_id)"))


def test_every_poll_collects_all_names(polls):
    rows = [r for r in tm.collect_samples(polls).collect() if r.poll_id == 2]
    assert len(rows) == len(S.RUNTIME_NAMES) + 2
    gauges = {r.name: r.value for r in rows if r.type == "gauge"}
    assert gauges.keys() == {*S.RUNTIME_NAMES, "RandomValue"}
    assert gauges["GCCPUFraction"] == 0 and gauges["HeapAlloc"] == 0 and gauges["TotalAlloc"] == 26
    assert 0 <= gauges["RandomValue"] < 1
    assert [(r.name, r.delta, r.value) for r in rows if r.type == "counter"] == [("PollCount", 1, None)]
    assert tm.poll_count(polls).first().delta == 3


def test_random_values_are_repeatable_and_spread(spark):
    polls = spark.range(4000).select(F.col("id").alias("poll_id"), F.lit(0).alias("ts"), F.lit(1.0).alias("Alloc"))
    draw = lambda df, **o: {r.poll_id: r.value for r in tm.collect_samples(df, **o).where("name = 'RandomValue'").collect()}
    first = draw(polls)
    assert first == draw(polls.repartition(5)) != draw(polls, seed=1)
    assert abs(sum(first.values()) / 4000 - 0.5) < 0.03


def test_unpivot_keeps_the_readings(polls):
    rows = {r.name: r.value for r in tm.unpivot_samples(polls).where("poll_id = 1").collect()}
    assert math.isnan(rows["GCCPUFraction"]) and rows["HeapAlloc"] == -math.inf


def test_ticks(spark):
    times = ["00:00:00", "00:00:02", "00:00:02.000001", "00:00:10", "00:00:10.5", "00:01:00"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "n int, t string")
    rows = rows.select("n", F.expr("cast('2024-01-01 ' || t as timestamp_ntz)").alias("ts"))
    got = [(r.poll_tick, r.report_tick) for r in tm.report_ticks(rows).orderBy("n").collect()]
    assert got == [(1, 1), (1, 1), (2, 1), (5, 1), (6, 2), (30, 6)]


@pytest.fixture(scope="module")
def ticked(spark):
    rows = [
        (1, 1, "counter", "c", None, 2), (2, 1, "gauge", "g", 1.0, None), (3, 1, "gauge", "g", 2.0, None),
        (4, 4, "counter", "c", None, 5), (5, 3, "gauge", "h", math.inf, None), (6, 5, "gauge", "g", 9.0, None),
    ]
    return spark.createDataFrame(rows, TICKED)


def brute_reports(rows):
    out = {}
    for tick in range(1, 6):
        state = {}
        for r in sorted(rows, key=lambda r: r.seq):
            if r.tick <= tick:
                key = (tick, r.type, r.name)
                state[key] = r.value if r.type == "gauge" else state.get(key, 0) + r.delta
        out |= state
    return out


def test_cumulative_reports_repeat_everything_seen(ticked):
    rows = tm.report_cumulative(ticked).collect()
    got = {(r.tick, r.type, r.name): r.value if r.type == "gauge" else r.delta for r in rows}
    want = brute_reports(ticked.collect())
    assert got == want and len(rows) == len(want)
    total = sum(v for (_, kind, _), v in want.items() if kind == "counter")
    assert [(r.name, r.delta) for r in tm.report_overcount(ticked).collect()] == [("c", total)]


def test_payloads(ticked, tmp_path):
    reports = tm.report_cumulative(ticked)
    payloads = tm.report_payload(reports)
    by_tick = {r.tick: json.loads(r.payload) for r in payloads.collect()}
    assert by_tick[1] == [{"id": "c", "type": "counter", "delta": 2}, {"id": "g", "type": "gauge", "value": 2.0}]
    assert by_tick[5][2] == {"id": "h", "type": "gauge", "value": 0.0}
    tm.write_payloads(payloads, str(tmp_path / "out"))
    lines = [line for f in (tmp_path / "out").glob("*.gz") for line in gzip.decompress(f.read_bytes()).decode().splitlines()]
    assert sorted(map(json.loads, lines), key=str) == sorted(by_tick.values(), key=str)
    # Payloads read back as batches give the reported state.
    back = tm.decode_batches(payloads.withColumnRenamed("payload", "doc"))
    assert back.where("error IS NOT NULL").count() == 0 and back.count() == reports.count()


@pytest.mark.parametrize("keys", [500, 1000, 100_000])
def test_reports_are_split_only_on_request(spark, keys):
    reports = spark.range(keys).select(
        F.lit(1).alias("tick"), F.lit("counter").alias("type"), F.concat(F.lit("c"), "id").alias("name"),
        F.lit(None).cast("double").alias("value"), F.col("id").alias("delta"),
    )
    one = tm.report_payload(reports).collect()
    assert [(r.tick, r.part) for r in one] == [(1, 0)] and len(json.loads(one[0].payload)) == keys
    parts = [json.loads(r.payload) for r in tm.report_payload(reports, parts=8).collect()]
    assert len(parts) == 8 and max(map(len, parts)) < keys / 4
    assert sorted(m["delta"] for p in parts for m in p) == list(range(keys))


def test_ticks_and_ids_do_not_depend_on_the_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = "SELECT 1 AS seq, TIMESTAMP_NTZ'2024-03-10 00:30:00' AS ts UNION ALL SELECT 2, TIMESTAMP_NTZ'2024-03-10 03:30:00'"
    found = []
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            ticks = tm.report_ticks(spark.sql(rows)).orderBy("seq").collect()
            found.append(([(r.poll_tick, r.report_tick) for r in ticks], [r.id for r in tm.assign_ids(spark.sql(rows)).orderBy("seq").collect()]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1] and found[0][0][1] == (5400, 1080)
    with pytest.raises(Exception, match="before 1970"):
        tm.assign_ids(spark.sql("SELECT 1 AS seq, TIMESTAMP_NTZ'1969-12-31 23:59:59' AS ts")).collect()


def test_wire_encode(spark):
    texts = [("gauge", "NaN"), ("gauge", "+Inf"), ("gauge", "1.5"), ("counter", "7"), ("gauge", "not-float"), ("counter", "1.5"), ("histogram", "1")]
    rows = spark.createDataFrame([(i, t, "m", v) for i, (t, v) in enumerate(texts)], "n int, type string, name string, raw_value string")
    got = [(r.payload and json.loads(r.payload), r.error) for r in tm.wire_encode(rows).orderBy("n").collect()]
    gauge = lambda v: ({"id": "m", "type": "gauge", "value": v}, None)
    assert got == [
        gauge(0.0), gauge(0.0), gauge(1.5), ({"id": "m", "type": "counter", "delta": 7}, None),
        (None, "invalid_value"), (None, "invalid_value"), (None, "unsupported_type"),
    ]


def test_quality_report(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    report = lambda checks: {r.name: (r.status, r.error) for r in tm.quality_report(rows, checks).collect()}
    assert report({"missing": F.col("v").isNull(), "negative": F.col("v") < 0}) == {
        "missing": ("error", "1 rows"), "negative": ("ok", None), "overall": ("unhealthy", None),
    }
    assert report({}) == {"overall": ("ok", None)}


def test_interval_fold(spark, ticked):
    rows = ticked.withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(tick)"))
    got = {(r.start.day, r.name): r.value if r.type == "gauge" else r.delta for r in tm.interval_fold(rows, "1 day").collect()}
    assert got == {(2, "c"): 2, (2, "g"): 2.0, (5, "c"): 5, (4, "h"): math.inf, (6, "g"): 9.0}
