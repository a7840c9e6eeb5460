"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tallymark import schema as S
from tallymark.functions.numbers import format_float, format_int, parse_float, parse_int
from tallymark.functions.stage import computed_once
from tallymark.operators import fold, ids, merge, quality, query, report, validate
from tallymark.plans import views
from tallymark.session import shared_dir
from tallymark.sources import arrays, metric_table
from tallymark.sources import samples as sampling
from tallymark.sources import snapshots, updates
from tallymark.sources.files import file_system
from tallymark.streaming import jobs
from tallymark.streaming.store import StateStore

Query = Callable[[SparkSession, str], DataFrame]

STATE_COLUMNS = ("type", "name", "value", "delta")
_QUERIES: dict[str, Query] = {}


def registered(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.check_text(views.updates_raw(spark, sf_dir))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.valid(_checked(spark, sf_dir))


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.fold_state(_valid(spark, sf_dir))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.fold_state(_valid(spark, sf_dir).where(f"ts < {views.CUT}"))


def _new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid(spark, sf_dir).where(f"ts >= {views.CUT}")


def _ticked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Valid updates with the daily report tick that first ships them, and the last tick."""
    events = views.table(spark, sf_dir, "events")
    start = report.start_of(events)
    tick = lambda ts: report.tick(ts, start, report.DAY_SECONDS)
    return _valid(spark, sf_dir).withColumn("tick", tick(F.col("ts"))), tick(report.end_of(events))


# --- sources


@registered
def src_update_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validate.check_text(updates.updates_from_uris(views.update_uris(spark, sf_dir)))
    return rows.select("seq", "type", "name", "raw_value", "value", "delta", "error")


@registered
def src_update_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.decode_updates(views.update_docs(spark, sf_dir)).drop("doc")


@registered
def src_updates_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.decode_batches(views.batch_docs(spark, sf_dir)).drop("doc", "ts")


@registered
def lookup_strict_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = updates.decode_lookups(views.lookup_docs(spark, sf_dir)).drop("doc")
    return asked.withColumnRenamed("error", "request_error")


@registered
def collect_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.unpivot_samples(views.samples(spark, sf_dir))


@registered
def collect_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.normalize_samples(sampling.unpivot_samples(views.samples(spark, sf_dir)))


@registered
def collect_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.collect_samples(views.samples(spark, sf_dir))


@registered
def poll_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.poll_count(views.samples(spark, sf_dir))


# --- checks


@registered
def validate_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("seq", "type", "name", "raw_value", "value", "delta", "error")


@registered
def validate_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.check_typed(views.updates_typed(spark, sf_dir)).drop("ts")


@registered
def validate_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.updates_typed(spark, sf_dir).select("seq", F.col("name").alias("id"), "type", "value", "delta")
    return validate.check_snapshot(rows)


@registered
def rejects_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.rejects_by_code(_checked(spark, sf_dir))


@registered
def batch_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.batch_verdicts(validate.check_typed(views.updates_typed(spark, sf_dir)))


@registered
def batch_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.drop_rejected_batches(_checked(spark, sf_dir)).select("batch_id", "seq", *STATE_COLUMNS)


@registered
def batch_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.batch_profile(_checked(spark, sf_dir))


def _rules() -> dict[str, Column]:
    names = (S.NAME_EMPTY, S.UNSUPPORTED_TYPE, S.INVALID_VALUE, S.NAME_TOO_LONG, S.TYPE_TOO_LONG)
    return {name: F.col("error") == name for name in names} | {"time_missing": F.col("ts").isNull()}


@registered
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(validate.check_text(views.updates_raw(spark, sf_dir), max_lengths=True), _rules())


@registered
def quality_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = Observation("quality")
    rows = validate.check_text(views.updates_raw(spark, sf_dir), max_lengths=True)
    quality.observed(rows, _rules(), seen).write.parquet(shared_dir(spark, "checked"))  # the rows' only pass
    return quality.observed_report(spark, seen)


@registered
def scalar_parse_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = views.table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_extendedprice * 1000 AS STRING) AS number_text",
        "CAST(l_discount / 100 AS STRING) AS small_text",
        "CAST(l_orderkey AS STRING) AS int_text",
    )
    parsed = computed_once(
        texts,
        number=parse_float(F.col("number_text")),
        small=parse_float(F.col("small_text")),
        int=parse_int(F.col("int_text")),
        int_of_number=parse_int(F.col("number_text")),
    )
    return parsed.select(
        "number",
        format_float(F.col("number")).alias("number_shown"),
        format_float(F.col("small")).alias("small_shown"),
        "int",
        "int_of_number",
        format_int(-F.col("int")).alias("int_shown"),
    )


# --- folds


@registered
def fold_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.fold_gauges(_valid(spark, sf_dir))


@registered
def fold_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.fold_counters(_valid(spark, sf_dir))


@registered
def fold_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.fold_state(_valid(spark, sf_dir), ts="ts")


@registered
def fold_state_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.fold_state(views.updates_wide(spark, sf_dir))


@registered
def fold_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _valid(spark, sf_dir).withColumn("id", F.concat(F.lit("id_"), F.col("seq").cast("string")))
    return fold.fold_ids(rows)


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.assign_ids(_valid(spark, sf_dir))


@registered
def fold_uuids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.fold_uuids(_identified(spark, sf_dir), ids="last")


@registered
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.latest_rows(_valid(spark, sf_dir)).drop("ts")


@registered
def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.assign_ids(_valid(spark, sf_dir)).select("seq", "type", "name", "id")


# --- merges


@registered
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.upsert(_base(spark, sf_dir), _new(spark, sf_dir))


@registered
def state_upsert_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _identified(spark, sf_dir)
    base = fold.fold_state(rows.where(f"ts < {views.CUT}"), ts="ts", ids="first")
    return merge.upsert(base, rows.where(f"ts >= {views.CUT}"), ts="ts", ids="first")


@registered
def state_upsert_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.updates_wide(spark, sf_dir)
    base = fold.fold_state(rows.where(f"ts < {views.WIDE_CUT}"))
    return merge.upsert(base, rows.where(f"ts >= {views.WIDE_CUT}"))


@registered
def state_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.replace(_base(spark, sf_dir), fold.fold_state(_new(spark, sf_dir)))


@registered
def state_merge_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_add(_base(spark, sf_dir), merge.to_snapshot(fold.fold_state(_new(spark, sf_dir))))


@registered
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.key_violations(views.updates_raw(spark, sf_dir))


@registered
def rename_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(spark, sf_dir)
    mapping = state.where("type = 'counter'").selectExpr("type", "name AS old", "concat('total_', substring(name, 6)) AS new")
    return merge.rename(state, mapping)


# --- reading state


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State read back from a store that took the log in two epochs."""
    store = StateStore(spark, shared_dir(spark, "state"))
    rows = _valid(spark, sf_dir)
    store.apply(rows.where(f"ts < {views.CUT}"), 0)
    store.compact()
    store.apply(rows.where(f"ts >= {views.CUT}"), 1)
    return store.read()


@registered
def state_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.scan(_stored(spark, sf_dir))


@registered
def list_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.list_gauges(_state(spark, sf_dir))


@registered
def list_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.list_counters(_state(spark, sf_dir))


@registered
def list_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.list_state(_state(spark, sf_dir))


@registered
def list_state_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.list_state(fold.fold_state(views.updates_wide(spark, sf_dir)))


@registered
def render_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.render_list(_state(spark, sf_dir))


@registered
def lookup_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.lookup_point(_stored(spark, sf_dir), S.GAUGE, "val_click_3").select(*STATE_COLUMNS)


@registered
def lookup_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.lookup_many(_state(spark, sf_dir), views.lookup_requests(spark, sf_dir))


@registered
def lookup_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.lookup_typed(_state(spark, sf_dir), views.lookup_requests(spark, sf_dir))


@registered
def lookup_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = updates.decode_lookups(views.lookup_docs(spark, sf_dir)).drop("doc")
    return query.lookup_json(_state(spark, sf_dir), asked).select("seq", "payload", "error", "status")


# --- the relational table


def _table(spark: SparkSession) -> dict[str, str]:
    """A new database file in the shared folder; it is opened inside the tasks, and no server runs."""
    metric_table.register(spark)
    fs, folder = file_system(spark, shared_dir(spark, "table"))
    fs.mkdirs(folder)
    return {"database": f"{folder.toUri().getPath()}/metrics.db"}


def _read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format(metric_table.FORMAT).options(**options).load().select(*STATE_COLUMNS)


@registered
def sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = _table(spark)
    rows = _valid(spark, sf_dir).select("seq", "ts", *STATE_COLUMNS)
    for epoch, delivery in enumerate((f"ts < {views.CUT}", f"ts >= {views.CUT}", f"ts >= {views.CUT}")):
        repeated = {"stream": "log", "epoch": str(min(epoch, 1))}  # the last delivery comes twice and counts once
        folded = fold.fold_state(rows.where(delivery))
        folded.write.format(metric_table.FORMAT).options(**options, **repeated).mode("append").save()
    return _read_table(spark, options)


@registered
def sink_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    options, folder, target = _table(spark), shared_dir(spark, "arrivals"), shared_dir(spark, "sink")
    rows = _valid(spark, sf_dir).select("seq", "ts", *STATE_COLUMNS)
    for delivery in (f"ts < {views.CUT}", f"ts >= {views.CUT}"):
        rows.where(delivery).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        writer = stream.drop("ts").writeStream.format(metric_table.FORMAT).options(**options, stream="log")
        writer.option("checkpointLocation", target).trigger(availableNow=True).start().awaitTermination()
    return _read_table(spark, options)


# --- snapshots


def _saved(spark: SparkSession, state: DataFrame) -> str:
    path = shared_dir(spark, "snapshot")
    snapshots.save_snapshot(state, path)
    return path


@registered
def snapshot_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _saved(spark, _state(spark, sf_dir))
    return spark.read.schema(S.SNAPSHOT).json(f"{path}/version=1")


@registered
def snapshot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _saved(spark, _state(spark, sf_dir))
    return snapshots.load_snapshot(spark, path).drop("pos")


@registered
def snapshot_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "array")
    arrays.save_array(_state(spark, sf_dir), path)
    return snapshots.load_snapshot(spark, path)


@registered
def restore_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = snapshots.load_snapshot(spark, _saved(spark, fold.fold_state(_new(spark, sf_dir))))
    return merge.restore(_base(spark, sf_dir), snapshot, "pos")


# --- reports


@registered
def wire_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.wire_encode(views.updates_raw(spark, sf_dir)).select("seq", "payload", "error")


@registered
def report_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_ticks(views.samples(spark, sf_dir)).select("poll_id", "poll_tick", "report_tick")


@registered
def report_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, last = _ticked(spark, sf_dir)
    return report.report_cumulative(rows, last_tick=last)


@registered
def report_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, last = _ticked(spark, sf_dir)
    return report.report_cumulative(rows, last_tick=last - 3, first_tick=last - 12)


@registered
def report_overcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, last = _ticked(spark, sf_dir)
    return report.report_overcount(rows, last_tick=last)


@registered
def report_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, last = _ticked(spark, sf_dir)
    reports = report.report_cumulative(rows, last_tick=last)
    return report.report_payload(reports)


@registered
def window_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.interval_fold(_valid(spark, sf_dir), "1 day")


# --- streams


def _arrivals(rows: DataFrame, label: str) -> tuple[str, int]:
    """Rows as a folder of files for a stream to read, one for each shuffle partition, and a quarter of their number."""
    spark = rows.sparkSession
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = shared_dir(spark, label)
    rows.repartitionByRange(files, "seq").write.parquet(folder)
    return folder, -(-files // 4)


@registered
def stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _valid(spark, sf_dir).select("seq", "ts", *STATE_COLUMNS)
    (folder, files), target = _arrivals(rows, "arrivals"), shared_dir(spark, "fold")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)
    jobs.run_fold(stream, target, state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return jobs.read_fold(spark, target).select(*STATE_COLUMNS)


@registered
def stream_fold_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _valid(spark, sf_dir).select("seq", "ts", *STATE_COLUMNS)
    (folder, files), target = _arrivals(rows, "arrivals"), shared_dir(spark, "fold")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)
    jobs.run_fold(stream, target, state_partitions=spark.sparkContext.defaultParallelism, copy=False).awaitTermination()
    return jobs.read_running(spark, target).select(*STATE_COLUMNS)


@registered
def stream_fold_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _new(spark, sf_dir).select("seq", "ts", *STATE_COLUMNS)
    (folder, files), target = _arrivals(rows, "arrivals"), shared_dir(spark, "fold")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)
    snapshot = _saved(spark, _base(spark, sf_dir))
    jobs.run_fold(stream, target, state_partitions=spark.sparkContext.defaultParallelism, snapshot=snapshot).awaitTermination()
    return jobs.read_fold(spark, target).select(*STATE_COLUMNS)


@registered
def stream_batch_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _checked(spark, sf_dir).withColumn("n_items", F.count("*").over(Window.partitionBy("batch_id")))
    rows = rows.select("batch_id", "n_items", "seq", *STATE_COLUMNS, "error")
    folder, target = shared_dir(spark, "arrivals"), shared_dir(spark, "batches")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(files, "seq").write.parquet(folder)  # so that most batches are spread over files
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files // 2)).parquet(folder)
    jobs.run_whole_batches(stream, target, state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return jobs.read_whole_batches(spark, target).select("batch_id", "seq", *STATE_COLUMNS)


def _upserted(spark: SparkSession, rows: DataFrame, snapshot: str | None = None, decode=jobs.batch_documents) -> str:
    """Run the upsert stream over rows that arrive in two deliveries; the later one counts as newer."""
    folder, target = shared_dir(spark, "documents"), shared_dir(spark, "upsert")
    for delivery in (f"ts < {views.CUT}", f"ts >= {views.CUT}"):
        rows.where(delivery).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        running = jobs.run_upsert(stream, target, interval=None, decode=decode)
        if snapshot:
            jobs.finish(running, target, snapshot)
        running.awaitTermination()
    return target


@registered
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.open_store(spark, _upserted(spark, views.batch_docs(spark, sf_dir))).read().select(*STATE_COLUMNS)


@registered
def stream_update_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _upserted(spark, views.updates_raw(spark, sf_dir), decode=jobs.text_updates)
    return jobs.open_store(spark, target).read().select(*STATE_COLUMNS)


@registered
def stream_update_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _upserted(spark, views.timed_docs(spark, sf_dir), decode=jobs.single_documents)
    return jobs.open_store(spark, target).read().select(*STATE_COLUMNS)


@registered
def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = shared_dir(spark, "snapshot")
    _upserted(spark, views.batch_docs(spark, sf_dir), snapshot)
    return snapshots.load_snapshot(spark, snapshot).drop("pos")
