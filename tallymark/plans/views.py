"""Metric inputs derived from the given tables.

Each select list is written once in SQL that Spark and DuckDB share, so both engines start from the
same rows; some rows carry defects on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark import schema as S

# Ordered text updates, in batches of 20, from `events`.
RAW = {
    "seq": "event_id",
    "ts": "ts",
    "batch_id": "CAST(floor(event_id / 20.0) AS BIGINT)",
    "name": """CASE WHEN event_id % 97 = 5 THEN ''
        WHEN event_id % 2 = 0 THEN concat('val_', event_type, '_', CAST(user_id % 10 AS STRING))
        ELSE concat('hits_', event_type) END""",
    "type": """CASE WHEN event_id % 101 = 7 THEN 'histogram'
        WHEN event_id % 2 = 0 THEN 'gauge' ELSE 'counter' END""",
    "raw_value": """CASE WHEN event_id % 89 = 3 THEN 'abc'
        WHEN event_id % 2 = 0 THEN CAST(value AS STRING)
        ELSE regexp_extract(props, '([0-9]+)', 1) END""",
}

# Typed updates from `events`: some operands are missing, some of the other kind are set as well.
TYPED = {
    "seq": "event_id",
    "ts": "ts",
    "batch_id": RAW["batch_id"],
    "name": RAW["name"],
    "type": RAW["type"],
    "delta": """CASE WHEN event_id % 83 = 2 THEN NULL WHEN event_id % 2 = 1 OR event_id % 79 = 4
        THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END""",
    "value": """CASE WHEN event_id % 83 = 2 THEN NULL WHEN event_id % 2 = 0 OR event_id % 79 = 4
        THEN value END""",
}

# Update request paths, some with a trailing slash, from the text updates.
URI = {
    "seq": "seq",
    "uri": "concat('/update/', type, '/', name, '/', raw_value, CASE WHEN seq % 3 = 0 THEN '/' ELSE '' END)",
}

# JSON documents of single updates from the text updates, good and bad ones.
DOC = {
    "seq": "seq",
    "doc": """concat(
        CASE WHEN seq % 67 = 9 THEN '{"ID":"' ELSE '{"id":"' END, name,
        CASE WHEN seq % 67 = 9 THEN '","Type":"' ELSE '","type":"' END, type, '"',
        CASE WHEN seq % 59 = 11 THEN ',"host":{"a":[1]}' ELSE '' END,
        CASE WHEN seq % 83 = 2 THEN ''
             WHEN seq % 61 = 10 THEN CASE WHEN type = 'gauge' THEN ',"value":1.5' ELSE ',"delta":1.5' END
             WHEN raw_value = 'abc' THEN ',"value":"abc"'
             WHEN type = 'gauge' THEN concat(',"value":', raw_value)
             ELSE concat(',"delta":', raw_value) END,
        CASE WHEN seq % 71 = 6 THEN '' WHEN seq % 73 = 8 THEN '} {"id":"x"}' ELSE '}' END)""",
}

# Strict lookup documents from the text updates.
LOOKUP_DOC = {
    "seq": "seq",
    "doc": """concat('{"id":"', name, '","type":"', type, '"',
        CASE WHEN seq % 59 = 11 THEN ',"host":"a"' WHEN seq % 61 = 10 THEN ',"value":3' ELSE '' END,
        CASE WHEN seq % 71 = 6 THEN '' WHEN seq % 73 = 8 THEN '}{}' ELSE '}' END)""",
}

# One poll per event: four of the runtime names, with NaN and infinity among the readings.
SAMPLES = {
    "poll_id": "event_id",
    "ts": "ts",
    "Alloc": "value",
    "HeapAlloc": "value * 2",
    "Frees": "CASE WHEN event_id % 50 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE CAST(user_id AS DOUBLE) END",
    "GCCPUFraction": "CASE WHEN event_id % 50 = 1 THEN CAST('NaN' AS DOUBLE) ELSE value END",
}
SAMPLES |= {name: f"value + {i}" for i, name in enumerate(S.RUNTIME_NAMES) if name not in SAMPLES}

# A gauge per customer and a counter per part: many keys. Only gauges need a unique order.
WIDE_GAUGES = {
    "seq": "o_orderkey",
    "ts": "o_orderdate",
    "name": "concat('spend_', CAST(o_custkey AS STRING))",
    "type": "'gauge'",
    "delta": "CAST(NULL AS BIGINT)",
    "value": "o_totalprice",
}
WIDE_COUNTERS = {
    "seq": "l_orderkey",
    "ts": "l_shipdate",
    "name": "concat('qty_', CAST(l_partkey AS STRING))",
    "type": "'counter'",
    "delta": "CAST(l_quantity AS BIGINT)",
    "value": "CAST(NULL AS DOUBLE)",
}

# What came before this time counts as stored state, the rest as new updates.
CUT = "TIMESTAMP_NTZ '2024-01-16 00:00:00'"
WIDE_CUT = "TIMESTAMP_NTZ '1998-07-01 00:00:00'"


def columns(select: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in select.items()]


# Columns the views read. Naming them spares a job that would infer the schema from the files.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double,
        l_discount double, l_shipdate timestamp_ntz""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, select: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*columns(select))


def updates_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, RAW)


def updates_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, TYPED)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, SAMPLES)


def update_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates_raw(spark, sf_dir).selectExpr(*columns(URI))


def update_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates_raw(spark, sf_dir).selectExpr(*columns(DOC))


def timed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates_raw(spark, sf_dir).selectExpr("ts", *columns(DOC))


def lookup_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates_raw(spark, sf_dir).selectExpr(*columns(LOOKUP_DOC))


def updates_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    gauges = table(spark, sf_dir, "orders").selectExpr(*columns(WIDE_GAUGES))
    return gauges.unionByName(table(spark, sf_dir, "lineitem").selectExpr(*columns(WIDE_COUNTERS)))


def batch_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array per batch of 20 typed updates; some are cut off, ``[]`` or ``null``."""
    metric = F.struct("seq", F.col("name").alias("id"), "type", "delta", "value")
    batches = updates_typed(spark, sf_dir).groupBy("batch_id").agg(
        F.max("ts").alias("ts"),
        F.to_json(F.transform(F.array_sort(F.collect_list(metric)), lambda m: m.dropFields("seq"))).alias("doc"),
    )
    doc = (
        F.when(F.col("batch_id") % 13 == 4, F.substring("doc", F.lit(1), F.length("doc") - 2))
        .when(F.col("batch_id") % 17 == 5, F.lit("null"))
        .when(F.col("batch_id") % 19 == 6, F.lit("[]"))
        .otherwise(F.col("doc"))
    )
    return batches.withColumn("doc", doc)


def lookup_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key, and three requests that find nothing."""
    keys = updates_raw(spark, sf_dir).where("name <> '' AND type <> 'histogram'").select("type", "name").distinct()
    missing = spark.createDataFrame([("gauge", "Missing"), ("hist", "Any"), ("gauge", "")], "type string, name string")
    return keys.unionByName(missing)
