"""Reading state: scans, listings and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import schema as S
from tallymark.functions.numbers import format_float, format_int, is_finite
from tallymark.functions.text import html_escape
from tallymark.operators.validate import blank, status_code, unsupported


def shown_value(kind: Column, value: Column, delta: Column) -> Column:
    """Operand of a row as text."""
    return F.when(kind == S.GAUGE, format_float(value)).when(kind == S.COUNTER, format_int(delta))


def scan(state: DataFrame) -> DataFrame:
    """All rows, ordered by type and name (bytewise)."""
    return state.orderBy(*S.KEY)


def list_gauges(state: DataFrame) -> DataFrame:
    return state.where(F.col("type") == S.GAUGE).select("name", "value").orderBy("name")


def list_counters(state: DataFrame) -> DataFrame:
    return state.where(F.col("type") == S.COUNTER).select("name", "delta").orderBy("name")


def list_state(state: DataFrame) -> DataFrame:
    """Listing ``(type, name, value)`` as text, counters before gauges."""
    text = shown_value(F.col("type"), F.col("value"), F.col("delta"))
    return state.orderBy(*S.KEY).select(*S.KEY, text.alias("value"))  # formatted once, after the sort


def render_list(state: DataFrame) -> DataFrame:
    """The listing as HTML-escaped lines ``type name = value``, in order."""
    text = shown_value(F.col("type"), F.col("value"), F.col("delta"))
    line = F.concat(
        html_escape(F.col("type")), F.lit(" "), html_escape(F.col("name")), F.lit(" = "), html_escape(text)
    )
    return state.orderBy(*S.KEY).select(line.alias("line"))


def lookup_point(state: DataFrame, kind: str, name: str) -> DataFrame:
    """The row of one key, if any. Over stored state both conditions reach the scan."""
    return state.where((F.col("type") == kind) & (F.col("name") == name))


def _matched(state: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests with the state row of their key.

    The semi join first shrinks the state to the asked keys: with few requests it broadcasts them
    and the state is never shuffled; with many, both joins share one partitioning by key.
    """
    rows = state.select(*S.KEY, "value", "delta")
    asked = rows.join(requests.select(*S.KEY), list(S.KEY), "left_semi")
    return requests.join(asked, list(S.KEY), "left")


def lookup_typed(state: DataFrame, requests: DataFrame) -> DataFrame:
    """Bulk lookup with typed operands, an ``error`` and its status. Names are not checked."""
    found = F.col("value").isNotNull() | F.col("delta").isNotNull()
    error = F.when(unsupported(F.col("type")), F.lit(S.UNSUPPORTED_TYPE)).when(~found, F.lit(S.NOT_FOUND))
    answered = _matched(state, requests).withColumn("error", error)
    return answered.withColumn("status", status_code(F.col("error")))


def lookup_many(state: DataFrame, requests: DataFrame) -> DataFrame:
    """Bulk lookup with the operand as text."""
    text = shown_value(F.col("type"), F.col("value"), F.col("delta"))
    return lookup_typed(state, requests).withColumn("value", text).drop("delta")


def lookup_json(state: DataFrame, requests: DataFrame) -> DataFrame:
    """Answers to strict JSON lookups ``(type, name, error)``: ``payload`` is the metric as a JSON object, where there is
    one, with its ``error`` and ``status``.

    A request that could not be read keeps its error; then the type, the name and the key decide. JSON has no NaN or
    infinity, so such a gauge is found but cannot be answered.
    """
    found = F.col("value").isNotNull() | F.col("delta").isNotNull()
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(unsupported(F.col("type")), F.lit(S.UNSUPPORTED_TYPE))
        .when(blank(F.col("name")), F.lit(S.NAME_EMPTY))
        .when(~found, F.lit(S.NOT_FOUND))
        .when(F.col("value").isNotNull() & ~is_finite(F.col("value")), F.lit(S.NOT_FINITE))
    )
    answered = _matched(state, requests).withColumn("error", error)
    item = F.struct(F.col("name").alias("id"), "type", "delta", "value")
    refused = F.col("error").isin(S.NAME_EMPTY, S.MALFORMED_JSON)
    status = F.when(refused, F.lit(S.STATUS[S.MALFORMED_JSON])).otherwise(status_code(F.col("error")))
    payload = F.when(F.col("error").isNull(), F.to_json(item))
    return answered.withColumns({"payload": payload, "status": status}).drop("value", "delta")
