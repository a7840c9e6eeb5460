"""Relational state table: partitioned reads, and upserts that survive retried tasks.

Spark's JDBC writer has no upsert, and adding counters straight from tasks would count a retried
partition twice. So tasks only stage their folded rows, where a repeat changes nothing, and one
transaction then merges an epoch and marks it as applied.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark import schema as S

# Waits before the repeated attempts, in seconds (fixed values).
RETRY_SECONDS = (1, 3, 5)
# SQLSTATE codes, and the class of codes, after which another attempt may succeed (fixed values).
RETRIABLE = ("40001", "40P01", "57P01", "53300")
RETRIABLE_CLASS = "08"

ROWS_PER_STATEMENT = 1000

Connect = Callable[[], object]


def is_retriable(error: Exception) -> bool:
    code = getattr(error, "sqlstate", None) or getattr(error, "pgcode", None) or ""
    return code in RETRIABLE or code.startswith(RETRIABLE_CLASS)


def with_retries(attempt: Callable[[], object], retriable=is_retriable, waits=RETRY_SECONDS, sleep=time.sleep):
    """Run ``attempt`` again after each wait while its error is retriable."""
    for wait in waits:
        try:
            return attempt()
        except Exception as error:
            if not retriable(error):
                raise
        sleep(wait)
    return attempt()


def in_transaction(connect: Connect, work: Callable[[object], None]) -> None:
    """One transaction on a new DB-API connection, repeated whole on retriable errors."""

    def attempt():
        connection = connect()
        try:
            work(connection.cursor())
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    with_retries(attempt)


def table_ddl(table: str = "metric") -> list[str]:
    """Statements that create the state table and the two tables of the upsert."""
    operands = "gauge_value DOUBLE PRECISION, counter_value BIGINT"
    key = f"name VARCHAR({S.MAX_NAME}) NOT NULL, type VARCHAR({S.MAX_TYPE}) NOT NULL"
    return [
        f"""CREATE TABLE IF NOT EXISTS {table} (id UUID PRIMARY KEY, {key}, {operands},
        created_at TIMESTAMPTZ NOT NULL DEFAULT CURRENT_TIMESTAMP, updated_at TIMESTAMPTZ NOT NULL DEFAULT CURRENT_TIMESTAMP,
        UNIQUE (name, type), CHECK ((gauge_value IS NULL) = (type = 'counter') AND
        (counter_value IS NULL) = (type = 'gauge') AND type IN ('gauge', 'counter')))""",
        f"CREATE TABLE IF NOT EXISTS {table}_staged (epoch BIGINT, id UUID, {key}, {operands}, PRIMARY KEY (epoch, name, type))",
        f"CREATE TABLE IF NOT EXISTS {table}_applied (epoch BIGINT PRIMARY KEY)",
    ]


def read_table(spark: SparkSession, url: str, table: str = "metric", predicates: list[str] | None = None, **properties: str) -> DataFrame:
    """State rows over JDBC, one scan per predicate (by default one per kind).

    For a large table give predicates that cut it into more, disjoint parts.
    """
    parts = predicates or [f"type = '{kind}'" for kind in S.KINDS]
    rows = spark.read.jdbc(url, table, predicates=parts, properties=properties)
    return rows.select(
        "type", "name", F.col("gauge_value").alias("value"), F.col("counter_value").alias("delta"), "created_at", "updated_at"
    )


def merge_statement(table: str, mark: str, add_counters: bool) -> str:
    added = f"{table}.counter_value + EXCLUDED.counter_value" if add_counters else "EXCLUDED.counter_value"
    return f"""INSERT INTO {table} (id, name, type, gauge_value, counter_value)
        SELECT id, name, type, gauge_value, counter_value FROM {table}_staged WHERE epoch = {mark}
        ON CONFLICT (name, type) DO UPDATE SET gauge_value = EXCLUDED.gauge_value,
        counter_value = {added}, updated_at = now()"""


def stage_rows(rows: Iterable, connect: Connect, table: str, epoch: int, mark: str) -> None:
    """Write the rows of one partition to the staging table; rows of a lost attempt stay as they are."""
    values = ", ".join([mark] * 6)
    statement = f"""INSERT INTO {table}_staged (epoch, id, name, type, gauge_value, counter_value)
        VALUES ({values}) ON CONFLICT (epoch, name, type) DO NOTHING"""
    for chunk in batched(rows, ROWS_PER_STATEMENT):
        in_transaction(
            connect,
            lambda cursor, chunk=chunk: cursor.executemany(
                statement, [(epoch, r.id, r.name, r.type, r.value, r.delta) for r in chunk]
            ),
        )


def upsert_table(
    folded: DataFrame,
    connect: Connect,
    epoch: int,
    table: str = "metric",
    add_counters: bool = True,
    connections: int = 16,
    mark: str = "%s",
) -> None:
    """Merge folded rows ``(id, type, name, value, delta)``, one per key, into the state table.

    Only the rows, one per key, are brought to so few tasks; the fold before keeps its own parallelism.
    ``connect`` opens a DB-API connection and runs on the executors, at most ``connections`` at a
    time. With ``add_counters`` off both kinds are replaced. An epoch that was applied is skipped.
    """
    folded.repartition(connections).foreachPartition(lambda rows: stage_rows(rows, connect, table, epoch, mark))

    def merge(cursor) -> None:
        cursor.execute(f"INSERT INTO {table}_applied (epoch) VALUES ({mark}) ON CONFLICT (epoch) DO NOTHING", (epoch,))
        if cursor.rowcount == 1:
            cursor.execute(merge_statement(table, mark, add_counters), (epoch,))
        cursor.execute(f"DELETE FROM {table}_staged WHERE epoch = {mark}", (epoch,))

    in_transaction(connect, merge)
