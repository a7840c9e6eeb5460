"""JSON-array snapshot files in parallel: written as ordered parts, read in pieces.

A reader cannot know from the middle of a file whether it stands inside a text or how deep it is nested. So every
piece of the file, up to a closing brace, is described by what it does to a reader that comes to it outside or inside
a text: how many quotes it has and how the depth changes in either case. These functions compose, so prefix sums
inside each split of the file and over the splits tell the state before every piece, and with it where elements end.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.functions import items as J
from tallymark.functions.numbers import is_finite
from tallymark.operators.merge import to_snapshot
from tallymark.operators.validate import check_snapshot, require
from tallymark.session import kept
from tallymark.sources.files import file_system

_PLACE = ("file", "block", "at")
_BLANKS = r"[ \t\r\n]*"


def pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block, at, size (of the file), text: the files cut behind every closing brace, which is left out.

    Any split of a file can be read alone.
    """
    rows = spark.read.option("lineSep", "}").text(paths)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_size").alias("size")]
    return rows.select(*place, F.col("value").alias("text"))


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _effects(rows: DataFrame) -> DataFrame:
    """Quotes of each piece, and the change of depth for a reader that comes outside (d0) or inside (d1) a text."""
    plain = rows.withColumn("plain", F.regexp_replace("text", r"(?s)\\.", ""))
    parts = plain.withColumns({"quotes": _count(F.col("plain"), '"'), "between": F.split("plain", '"', -1)})

    def change(start: int) -> Column:
        outside = F.array_join(F.filter("between", lambda _, i: i % 2 == start), "")
        opened = _count(outside, "{") + _count(outside, "[") - _count(outside, "]")
        ends_outside = (F.col("quotes") % 2 == start) & F.col("ended")
        return opened - F.when(ends_outside, 1).otherwise(0)

    return parts.select(*_PLACE, "size", "text", "ended", "quotes", change(0).alias("d0"), change(1).alias("d1"))


def elements(found: DataFrame) -> DataFrame | None:
    """pos, text of every element of an array of objects; None if the pieces are no such array.

    Text after the array is ignored; blanks and ``null`` are an empty array. A split's pieces are one window, the splits
    themselves another of a row each. The numbered pieces are kept in the checkpoint folder: whether there is an
    array, and where it ends, is known only after all of them.
    """
    last = found.groupBy("file").agg(F.max(F.struct("block", "at")).alias("last"))
    marked = found.join(last, "file").withColumn("ended", F.struct("block", "at") != F.col("last"))
    inside = Window.partitionBy("file", "block").orderBy("at")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    turned = _effects(marked).withColumn("turn", before("quotes") % 2)
    for s in (0, 1):
        turned = turned.withColumn(f"e{s}", F.when(F.col("turn") == s, F.col("d0")).otherwise(F.col("d1")))
    run = turned.withColumns({"run0": before("e0"), "run1": before("e1")})
    splits = run.groupBy("file", "block").agg(F.sum("quotes").alias("q"), F.sum("e0").alias("e0"), F.sum("e1").alias("e1"))
    in_order = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(in_order), F.lit(0))
    entered = splits.withColumn("start", so_far("q") % 2).withColumn("e", F.when(F.col("start") == 0, F.col("e0")).otherwise(F.col("e1")))
    entered = entered.select(F.col("file").alias("f"), F.col("block").alias("b"), "start", so_far("e").alias("depth"))
    same = (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))
    state = run.join(entered, same).drop("f", "b")
    outside = (F.col("start") + F.col("turn")) % 2 == 0
    depth = F.col("depth") + F.when(F.col("start") == 0, F.col("run0")).otherwise(F.col("run1"))
    change = F.when(outside, F.col("d0")).otherwise(F.col("d1"))
    ends_outside = (F.when(outside, 0).otherwise(1) + F.col("quotes")) % 2 == 0
    border = F.col("ended") & ends_outside & (depth + change == 1)
    closed = (outside & (depth == 1) & F.col("text").rlike(rf"\A{_BLANKS}\]")) | (outside & (depth == 0) & F.col("text").rlike(rf"\A{_BLANKS}\[{_BLANKS}\]"))
    known = state.select(*_PLACE, "size", "text", "ended", border.cast("long").alias("border"), closed.alias("closed"))
    counted = known.withColumn("inside", before("border"))
    offsets = known.groupBy("file", "block").agg(F.sum("border").alias("borders"))
    offsets = offsets.select(F.col("file").alias("f"), F.col("block").alias("b"), so_far("borders").alias("offset"))
    numbered = kept(counted.join(offsets, same).withColumn("pos", F.col("inside") + F.col("offset")))
    blank = (F.octet_length("text") == F.col("size")) & ((J.stripped(F.col("text")) == "") | J.is_null_document(F.col("text")))
    start = F.min(F.struct(*_PLACE, F.col("text").rlike(rf"\A{_BLANKS}\[").alias("open"), blank.alias("blank")))
    end = numbered.agg(F.min(F.when(F.col("closed"), F.col("pos"))).alias("n"), start.alias("start"), F.count("*").alias("pieces")).first()
    n = 0 if end.pieces == 0 or end.pieces == 1 and end.start["blank"] else end.n if end.start["open"] else None
    if n is None:
        return None
    piece = F.struct(*_PLACE, F.concat("text", F.when(F.col("ended"), "}").otherwise("")).alias("text"))
    grouped = numbered.where(F.col("pos") < n).groupBy("pos").agg(F.sort_array(F.collect_list(piece)).alias("parts"))
    texts = grouped.select("pos", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    bare = F.regexp_replace("text", F.when(F.col("pos") == 0, F.lit(rf"\A{_BLANKS}\[")).otherwise(F.lit(rf"\A{_BLANKS},")), "")
    # without its bracket or comma an element must begin; a text that lost neither begins with another sign
    led = F.col("text").rlike(rf"\A{_BLANKS}[\[,]{_BLANKS}\{{")
    return texts.select(F.col("pos").cast("int").alias("pos"), F.when(led, bare).alias("text"))


def array_parts(state: DataFrame) -> DataFrame:
    """line: the elements of the state's snapshot in order, with the brackets and commas of one indented JSON array.

    Rows are sorted by type and id, so the lines of all tasks one after the other are the array. Every row is checked.
    """
    checked = check_snapshot(to_snapshot(state))
    bad = F.when(F.col("value").isNotNull() & ~is_finite(F.col("value")), F.lit("not_finite"))
    rows = require(checked.withColumn("error", F.coalesce("error", bad)), F.col("error"), F.col("id"), "invalid snapshot row").drop("error")
    key = F.struct("type", "id")
    first, last = rows.agg(F.min(key), F.max(key)).first()
    if first is None:
        return state.sparkSession.createDataFrame([("[]",)], "line string")
    fields = []
    for name in ("id", "type", "value", "delta"):
        value = F.substring(F.to_json(F.struct(name)), F.lit(len(name) + 5), F.length(F.to_json(F.struct(name))) - len(name) - 5)
        fields.append(F.when(F.col(name).isNotNull(), F.concat(F.lit(f'    "{name}": '), value)))
    element = F.concat(F.lit("  {\n"), F.array_join(F.array_compact(F.array(*fields)), ",\n"), F.lit("\n  }"))
    is_key = lambda k: (F.col("type") == k["type"]) & (F.col("id") == k["id"])
    line = F.concat(F.when(is_key(first), "[\n").otherwise(""), element, F.when(is_key(last), "\n]").otherwise(","))
    return rows.orderBy("type", "id").select(line.alias("line"))


def save_array(state: DataFrame, path: str) -> None:
    """Write state as a folder of text parts that are, in the order of their names, one indented JSON array.

    The folder is written beside its place and renamed, so readers see the old parts or the new ones.
    """
    spark, base = state.sparkSession, path.rstrip("/")
    fresh = f"{base}.{uuid.uuid4().hex}.tmp"
    array_parts(state).write.text(fresh)
    _put(spark, fresh, base)


def join_parts(spark: SparkSession, folder: str, path: str) -> None:
    """The parts of ``folder`` as one file, copied one after the other and renamed at the end.

    Only for tools that cannot read parts: a file has one writer. ``load_snapshot`` reads the folder as it is.
    """
    fs, jfolder = file_system(spark, folder)
    fresh = f"{path}.{uuid.uuid4().hex}.tmp"
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(fresh))
    try:
        for part in sorted(s.getPath().toString() for s in fs.listStatus(jfolder) if s.getPath().getName().startswith("part-")):
            part_in = fs.open(spark._jvm.org.apache.hadoop.fs.Path(part))
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part_in, out, 1 << 20, False)
            part_in.close()
    finally:
        out.close()
    _put(spark, fresh, path)


def _put(spark: SparkSession, fresh: str, path: str) -> None:
    fs, jpath = file_system(spark, path)
    if fs.exists(jpath):
        fs.delete(jpath, True)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(fresh), jpath):
        raise RuntimeError(f"cannot rename {fresh} to {path}")
