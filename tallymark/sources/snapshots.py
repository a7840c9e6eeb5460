"""Snapshots: versioned JSON-lines folders, and JSON arrays in one file or in parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark import schema as S
from tallymark.functions import items as J
from tallymark.operators.merge import to_snapshot
from tallymark.operators.validate import check_snapshot, finite_values, require, snapshot_error
from tallymark.sources.arrays import elements, pieces
from tallymark.sources.files import Versions, file_system

_ROWS = "pos int, id string, type string, value double, delta bigint"


def _path(path: str) -> str:
    if not path.strip():
        raise ValueError("snapshot path is empty")
    return path


def save_snapshot(state: DataFrame, path: str) -> int:
    """Write state as the next snapshot version below ``path``, sorted by type and id.

    Every row is checked on its way out. JSON has no NaN or infinity, so such a gauge fails the
    save; like any failed save it leaves the version before as the newest.
    """
    versions = Versions(state.sparkSession, _path(path), S.SNAPSHOT, "json")
    done = versions.complete()
    number = done[-1] + 1 if done else 1
    checked = check_snapshot(to_snapshot(state))
    checked = checked.withColumn("error", F.coalesce("error", finite_values(checked)))
    rows = require(checked, F.col("error"), F.col("id"), "invalid snapshot row")
    versions.write(rows.drop("error").orderBy("type", "id"), number)
    return number


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(pos, id, type, value, delta)`` of a snapshot; fails on any invalid row.

    ``path`` is a folder written by ``save_snapshot`` (its newest complete version is read), a folder
    written by ``save_array``, or one JSON-array file; arrays are read by as many tasks as they have
    splits. A missing path, an empty file and ``null`` give no rows. ``pos`` is the position inside an
    array, 0 in a versioned folder, whose keys are unique.
    """
    fs, jpath = file_system(spark, _path(path))
    if not fs.exists(jpath):
        return spark.createDataFrame([], _ROWS)
    if fs.getFileStatus(jpath).isDirectory():
        if not fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/part-*")):
            done = Versions(spark, path, S.SNAPSHOT, "json").complete()
            files = [f"{path.rstrip('/')}/version={v}" for v in done[-1:]]
            return decode_snapshot(spark.read.text(files), False) if files else spark.createDataFrame([], _ROWS)
    return decode_array(spark, [path])


def decode_array(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Snapshot rows of one JSON array, whose text lies in these files one after the other."""
    texts = elements(pieces(spark, paths))
    if texts is None:
        return decode_snapshot(spark.createDataFrame([("]",)], "value string"), True)  # refused when it is read
    text = F.col("text")
    strict = F.coalesce(J.starts_with(text, "{") & ~J.has_unknown_field(text), F.lit(False))
    items = F.coalesce(F.when(strict, J.decode_items(text)), _unreadable())
    rows = texts.select("pos", F.explode(items).alias("item"))
    return _gated(rows).select("pos", "item.id", "item.type", "item.value", "item.delta")


def decode_snapshot(docs: DataFrame, whole: bool) -> DataFrame:
    """Snapshot rows of JSON texts in ``value``: arrays when ``whole``, else one object per line."""
    text = F.col("value")
    present = docs.where((J.stripped(text) != "") & ~J.is_null_document(text))
    start = "[" if whole else "{"
    strict = J.starts_with(text, start) & ~J.has_unknown_field(text, many=whole)
    items = F.coalesce(F.when(strict, J.decode_items(text)), _unreadable())
    # The stand-in for an unreadable text keeps it apart from an empty array and fails the gate below.
    rows = present.select(F.posexplode_outer(items).alias("pos", "item"))
    return _gated(rows, F.col("pos").isNotNull()).where("pos IS NOT NULL").select("pos", "item.id", "item.type", "item.value", "item.delta")


def _gated(rows: DataFrame, judged: Column | None = None) -> DataFrame:
    """``rows``, failing at the first item that is no snapshot row."""
    c = F.col
    error = snapshot_error(c("item.id"), c("item.type"), c("item.value"), c("item.delta"))
    error = F.when(c("item.type") == S.MALFORMED_JSON, F.lit(S.MALFORMED_JSON)).otherwise(error)
    return require(rows, error if judged is None else F.when(judged, error), c("item.id"), "invalid snapshot row")


def _unreadable():
    """Stands for a text that cannot be read: one item of no known type."""
    return F.array(
        F.struct(
            F.lit("").alias("id"),
            F.lit(S.MALFORMED_JSON).alias("type"),
            F.lit(None).cast("bigint").alias("delta"),
            F.lit(None).cast("double").alias("value"),
        )
    )
