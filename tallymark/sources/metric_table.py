"""The relational state table as a Spark data source: ``format("metric_table")`` for reads, batch writes and streams.

Tasks only stage their rows, each attempt under a name of its own, and report that name. The commit on the driver then
merges the rows of the reported attempts in one transaction, inside the database, and marks the epoch as applied. Rows
of lost or repeated attempts are never merged, and a replayed epoch changes nothing.

Any DB-API database with ``ON CONFLICT`` and window functions will do; the connection is opened by a function that the
option ``connect`` names (``module:function``, called with the option ``database``), by default ``sqlite3``.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from importlib import import_module

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tallymark.sources import database

for _module in (__name__, database.__name__):  # executors need no copy of the package
    cloudpickle.register_pickle_by_value(sys.modules[_module])

FORMAT = "metric_table"
_READ = {
    "id": pa.string(), "type": pa.string(), "name": pa.string(), "value": pa.float64(), "delta": pa.int64(),
    "created_at": pa.string(), "updated_at": pa.string(),
}
#: Rows of one read batch and of one staging transaction.
ROWS = 10_000
#: Seconds a statement waits for another writer of a database file.
WAIT_SECONDS = 120
#: Ids of keys that come without one are derived from the key under this name (fixed value).
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def open_sqlite(path: str):
    import sqlite3

    return sqlite3.connect(path.removeprefix("file://").removeprefix("file:"), timeout=WAIT_SECONDS)


@dataclass(frozen=True)
class Table:
    """Where the table is and how a statement names its parameters."""

    name: str
    database: str
    connect: str | None
    mark: str

    @staticmethod
    def of(options) -> Table:
        if "database" not in options:
            raise ValueError(f"{FORMAT} needs the option database")
        return Table(options.get("table", "metric"), options["database"], options.get("connect"), options.get("mark", "?"))

    def open(self):
        if self.connect is None:
            return open_sqlite(self.database)
        module, _, function = self.connect.partition(":")
        return getattr(import_module(module), function)(self.database)

    def run(self, work) -> None:
        """One transaction, repeated whole on errors that another attempt may not have."""
        database.in_transaction(self.open, work)

    def create(self) -> None:
        statements = [
            *database.table_ddl(self.name),
            f"""CREATE TABLE IF NOT EXISTS {self.name}_incoming (run VARCHAR(36) NOT NULL, attempt VARCHAR(36) NOT NULL, row BIGINT NOT NULL,
            seq NUMERIC, id VARCHAR(36), name VARCHAR(255) NOT NULL, type VARCHAR(70) NOT NULL, gauge_value DOUBLE PRECISION,
            counter_value BIGINT, accepted INTEGER NOT NULL DEFAULT 0, PRIMARY KEY (attempt, row))""",
            f"CREATE TABLE IF NOT EXISTS {self.name}_epochs (stream VARCHAR(255) NOT NULL, epoch BIGINT NOT NULL, PRIMARY KEY (stream, epoch))",
        ]
        self.run(lambda cursor: [cursor.execute(s) for s in statements] and None)


@dataclass
class Staged(WriterCommitMessage):
    run: str  # the tasks' copy of the writer, which need not be the one that commits
    attempt: str


class _Staging:
    """What the batch and the stream writer share: staging in tasks, merging on the driver."""

    def __init__(self, table: Table, schema: StructType, stream: str, add: bool):
        missing = {"type", "name", "value", "delta"} - set(schema.names)
        if missing:
            raise ValueError(f"{FORMAT} misses the columns {sorted(missing)}")
        self.table, self.stream, self.add = table, stream, add
        self.run = str(uuid.uuid4())

    def stage(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        attempt, count, t = str(uuid.uuid4()), 0, self.table
        marks = ", ".join([t.mark] * 9)
        statement = f"""INSERT INTO {t.name}_incoming (run, attempt, row, seq, id, name, type, gauge_value, counter_value)
            VALUES ({marks}) ON CONFLICT (attempt, row) DO NOTHING"""
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                column = lambda name, piece=piece: piece.column(name).to_pylist() if name in piece.schema.names else [None] * piece.num_rows
                rows = [
                    (self.run, attempt, count + i, None if seq is None else str(seq), key_id or str(uuid.uuid5(NAMESPACE, f"{kind}/{name}")), name, kind, value, delta)
                    for i, (seq, key_id, name, kind, value, delta) in enumerate(zip(*map(column, ("seq", "id", "name", "type", "value", "delta")), strict=True))
                ]
                t.run(lambda cursor, rows=rows: cursor.executemany(statement, rows))
                count += len(rows)
        return Staged(self.run, attempt)

    def merge(self, messages: list[Staged | None], epoch: int) -> None:
        t = self.table
        done = [m for m in messages if m is not None]

        def work(cursor) -> None:
            cursor.execute(f"INSERT INTO {t.name}_epochs (stream, epoch) VALUES ({t.mark}, {t.mark}) ON CONFLICT (stream, epoch) DO NOTHING", (self.stream, epoch))
            if cursor.rowcount == 1:
                cursor.executemany(f"UPDATE {t.name}_incoming SET accepted = 1 WHERE attempt = {t.mark}", [(m.attempt,) for m in done])
                cursor.execute(merge_statement(t, self.add))
            self._forget(cursor, done)

        t.run(work)

    def _forget(self, cursor, messages: list[Staged | None]) -> None:
        """Delete the staged rows of these runs, lost attempts included."""
        runs = {self.run, *[m.run for m in messages if m is not None]}
        cursor.executemany(f"DELETE FROM {self.table.name}_incoming WHERE run = {self.table.mark}", [(run,) for run in runs])

    def forget(self, messages: list[Staged | None]) -> None:
        self.table.run(lambda cursor: self._forget(cursor, messages))


def merge_statement(table: Table, add: bool) -> str:
    """Accepted rows, folded per key, into the table: the newest gauge, and counters added or the newest one.

    Rows are accepted and deleted in the transaction that merges them, so no other merge ever sees them.
    """
    folded = "SUM(counter_value)" if add else "MAX(CASE WHEN newest = 1 THEN counter_value END)"
    added = f"{table.name}.counter_value + EXCLUDED.counter_value" if add else "EXCLUDED.counter_value"
    return f"""INSERT INTO {table.name} (id, name, type, gauge_value, counter_value)
        SELECT MIN(CASE WHEN oldest = 1 THEN id END), name, type, MAX(CASE WHEN newest = 1 THEN gauge_value END), {folded} FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY name, type ORDER BY seq DESC) AS newest,
                ROW_NUMBER() OVER (PARTITION BY name, type ORDER BY seq) AS oldest
            FROM {table.name}_incoming WHERE accepted = 1) AS incoming
        WHERE 1 = 1 GROUP BY name, type
        ON CONFLICT (name, type) DO UPDATE SET gauge_value = EXCLUDED.gauge_value, counter_value = {added}, updated_at = CURRENT_TIMESTAMP"""


class TableWriter(_Staging, DataSourceArrowWriter):
    """A batch write is an epoch of its own, or the one that the option ``epoch`` names."""

    def __init__(self, table: Table, schema: StructType, stream: str, add: bool, epoch: int | None):
        _Staging.__init__(self, table, schema, stream if epoch is not None else f"batch {uuid.uuid4()}", add)
        self.epoch = 0 if epoch is None else epoch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.stage(iterator)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self.merge(messages, self.epoch)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.forget(messages)


class TableStreamWriter(_Staging, DataSourceStreamArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.stage(iterator)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.merge(messages, batchId)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.forget(messages)


class KeyRange(InputPartition):
    def __init__(self, first: tuple[str, str] | None, end: tuple[str, str] | None):
        super().__init__((first, end))
        self.first, self.end = first, end


class TableReader(DataSourceReader):
    """Scans of disjoint key ranges with about as many rows each."""

    def __init__(self, table: Table, ranges: int):
        self.table, self.ranges = table, ranges

    def partitions(self) -> list[InputPartition]:
        t, firsts = self.table, []
        numbered = f"SELECT type, name, ROW_NUMBER() OVER (ORDER BY type, name) - 1 AS place, COUNT(*) OVER () AS n FROM {t.name}"
        cut = f"place * {self.ranges} / n > (place - 1) * {self.ranges} / n"
        t.run(lambda cursor: firsts.extend(cursor.execute(f"SELECT type, name FROM ({numbered}) AS keys WHERE place > 0 AND {cut} ORDER BY type, name") and cursor.fetchall()))
        bounds = [None, *map(tuple, firsts), None]
        return [KeyRange(a, b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        t, values, where = self.table, [], ["1 = 1"]
        for bound, sign in ((partition.first, ">="), (partition.end, "<")):
            if bound is not None:
                where.append(f"(type, name) {sign} ({t.mark}, {t.mark})")
                values += bound
        connection = t.open()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT id, type, name, gauge_value, counter_value, created_at, updated_at FROM {t.name} WHERE {' AND '.join(where)}", values)
            while rows := cursor.fetchmany(ROWS):
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), _READ.values(), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=list(_READ))
        finally:
            connection.close()


class MetricTable(DataSource):
    """Options: ``database``, ``table``, ``connect``, ``mark``; for reads ``ranges``; for writes ``add`` (false: the
    newest counter replaces instead of adding), ``stream`` (name under which epochs are marked) and ``epoch``.

    Written rows have type, name, value and delta, optionally seq, which orders the rows of a key, and id.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "id string, type string, name string, value double, delta bigint, created_at string, updated_at string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return TableReader(Table.of(self.options), int(self.options.get("ranges", "8")))

    def _staged(self):
        table = Table.of(self.options)
        table.create()
        return partial(dict, table=table, stream=self.options.get("stream", "stream"), add=self.options.get("add", "true").lower() == "true")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError(f"{FORMAT} merges; use mode append")
        epoch = self.options.get("epoch")
        return TableWriter(**self._staged()(schema=schema), epoch=None if epoch is None else int(epoch))

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return TableStreamWriter(**self._staged()(schema=schema))


def register(spark: SparkSession) -> None:
    """Make ``format("metric_table")`` known to a session."""
    spark.dataSource.register(MetricTable)
