"""Column layouts, metric kinds and outcome names shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

GAUGE = "gauge"
COUNTER = "counter"
KINDS = (GAUGE, COUNTER)

# Key of a state row. The two kinds are separate namespaces.
KEY = ("type", "name")

# Outcome names of the checks, with the status each is answered with (fixed values).
NAME_EMPTY = "name_empty"
ID_EMPTY = "id_empty"
UNSUPPORTED_TYPE = "unsupported_type"
INVALID_VALUE = "invalid_value"
VALUE_REQUIRED = "value_required"
DELTA_REQUIRED = "delta_required"
OPERAND_MISMATCH = "operand_mismatch"
NAME_TOO_LONG = "name_too_long"
TYPE_TOO_LONG = "type_too_long"
MALFORMED_JSON = "malformed_json"
NO_ROUTE = "no_route"
NOT_FOUND = "not_found"
NOT_FINITE = "not_finite"

STATUS = {
    NAME_EMPTY: 404,
    NOT_FOUND: 404,
    NO_ROUTE: 404,
    UNSUPPORTED_TYPE: 400,
    INVALID_VALUE: 400,
    VALUE_REQUIRED: 400,
    DELTA_REQUIRED: 400,
    MALFORMED_JSON: 400,
}
STATUS_OK = 200
STATUS_OTHER = 500

# Column widths of the relational table (fixed values).
MAX_NAME = 255
MAX_TYPE = 70

# Names of one runtime sample (fixed values).
RUNTIME_NAMES = (
    "Alloc",
    "BuckHashSys",
    "Frees",
    "GCCPUFraction",
    "GCSys",
    "HeapAlloc",
    "HeapIdle",
    "HeapInuse",
    "HeapObjects",
    "HeapReleased",
    "HeapSys",
    "LastGC",
    "Lookups",
    "MCacheInuse",
    "MCacheSys",
    "MSpanInuse",
    "MSpanSys",
    "Mallocs",
    "NextGC",
    "NumForcedGC",
    "NumGC",
    "OtherSys",
    "PauseTotalNs",
    "StackInuse",
    "StackSys",
    "Sys",
    "TotalAlloc",
)
RANDOM_VALUE = "RandomValue"
POLL_COUNT = "PollCount"

TEXT_UPDATE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("raw_value", T.StringType()),
    ]
)

TYPED_UPDATE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("delta", T.LongType()),
    ]
)

STATE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("delta", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("delta", T.LongType()),
    ]
)
