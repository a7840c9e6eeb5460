"""Update sources: request paths, single JSON documents and JSON batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark import schema as S
from tallymark.functions import items as J
from tallymark.functions.stage import computed_once
from tallymark.functions.text import decode_path
from tallymark.operators.validate import typed_error


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per line as ``doc``; ``.gz`` files are unpacked, broken ones fail the job."""
    return spark.read.option("ignoreCorruptFiles", "false").text(path).withColumnRenamed("value", "doc")


def updates_from_uris(requests: DataFrame, uri: str = "uri") -> DataFrame:
    """``/update/{type}/{name}/{value}`` request paths as text updates.

    One trailing slash is allowed. Other paths keep their row with the error ``no_route``; the
    fields of those are NULL. Pass the result to ``check_text``.
    """
    path = F.substring_index(F.substring_index(F.col(uri), "?", 1), "#", 1)
    parts = computed_once(requests, parts=F.split(decode_path(path), "/"))
    part = lambda i: F.get("parts", F.lit(i))
    n = F.size("parts")
    routed = (
        (part(0) == "") & (part(1) == "update") & (part(4) != "")
        & ((n == 5) | ((n == 6) & (part(5) == "")))
    )
    return parts.withColumns(
        {
            "type": F.when(routed, part(2)),
            "name": F.when(routed, part(3)),
            "raw_value": F.when(routed, part(4)),
            "route_error": F.when(F.coalesce(routed, F.lit(False)), F.lit(None)).otherwise(F.lit(S.NO_ROUTE)),
        }
    ).drop("parts")


def _item_error(item: Column) -> Column:
    return typed_error(item["type"], item["id"], item["value"], item["delta"])


def _flatten(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Items as columns; a text field that is absent reads as empty, unless nothing was readable."""
    item = lambda f: F.col(f"item.{f}")
    readable = F.coalesce(F.col("error") != S.MALFORMED_JSON, F.lit(True))
    return rows.select(
        *keep,
        F.when(readable, F.coalesce(item("type"), F.lit(""))).alias("type"),
        F.when(readable, F.coalesce(item("id"), F.lit(""))).alias("name"),
        F.when(item("type") == S.GAUGE, item("value")).alias("value"),
        F.when(item("type") == S.COUNTER, item("delta")).alias("delta"),
        "error",
    )


def decode_updates(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Single-metric JSON documents as checked typed updates.

    The first JSON value counts and text after it is ignored; ``null`` is a metric without fields.
    """
    text = F.col(doc)
    items = F.when(J.starts_with(text, "{"), J.decode_items(text))
    # The item leaves a generator, so filters on the outcome do not repeat the parse below it.
    parsed = docs.select("*", F.explode_outer(items).alias("item"))
    unread = F.col("item").isNull() & ~F.coalesce(J.is_null_document(text), F.lit(False))
    error = F.when(unread, F.lit(S.MALFORMED_JSON)).otherwise(_item_error(F.col("item")))
    return _flatten(parsed.withColumn("error", error), docs.columns)


def decode_batches(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """JSON-array documents as one row per metric, in document order (``pos``).

    ``error`` is the outcome of the whole document: the first element with a wrong type or operand,
    else the first with an empty name, else none. A batch is a row here, so all-or-nothing needs no
    shuffle. An unreadable document gives one row without fields; ``[]`` and ``null`` give none.
    """
    text = F.col(doc)
    present = docs.where(~F.coalesce(J.is_null_document(text), F.lit(False)))
    parsed = computed_once(present, items=F.when(J.starts_with(text, "["), J.decode_items(text)))
    items = F.col("items")
    errors = F.transform(items, _item_error)
    at_once = F.get(F.filter(errors, lambda e: e.isNotNull() & (e != S.NAME_EMPTY)), F.lit(0))
    named = F.get(F.filter(errors, lambda e: e.isNotNull()), F.lit(0))
    error = F.when(items.isNull(), F.lit(S.MALFORMED_JSON)).otherwise(F.coalesce(at_once, named))
    judged = computed_once(parsed, error=error)
    exploded = judged.select(*docs.columns, "error", F.posexplode_outer(items).alias("pos", "item"))
    filled = exploded.where(F.col("pos").isNotNull() | F.col("error").isNotNull())
    return _flatten(filled, [*docs.columns, "pos"])


def decode_lookups(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Strict lookup documents as ``(type, name)``: unknown fields or a second value are an ``error``.

    Every legal request is one flat object, so the flat-object pattern also rules out whatever
    follows it.
    """
    text = F.col(doc)
    strict = J.is_single_flat_object(text) & ~J.has_unknown_field(text)
    parsed = docs.select("*", F.explode_outer(F.when(strict, J.decode_items(text))).alias("item"))
    unread = F.col("item").isNull() & ~F.coalesce(J.is_null_document(text), F.lit(False))
    error = F.when(unread, F.lit(S.MALFORMED_JSON))
    return _flatten(parsed.withColumn("error", error), docs.columns).drop("value", "delta")
