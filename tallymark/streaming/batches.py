"""All-or-nothing batches whose rows arrive one by one on a stream."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

#: Rows that enter or leave the state together.
RELEASE_ROWS = 10_000
#: Groups that batches are dealt into by a hash. A state is opened once a group, not once a batch.
GROUPS = 1024

COLUMNS = "batch_id bigint, seq bigint, type string, name string, value double, delta bigint"


class Open:
    """What is known of a batch that has not filled up: its rows so far, its size, bad rows, last arrival, and chunks."""

    __slots__ = ("n", "n_items", "bad", "last", "chunks")

    def __init__(self, n: int = 0, n_items: int = 0, bad: int = 0, last: int = 0, chunks: list[int] = ()):
        self.n, self.n_items, self.bad, self.last, self.chunks = n, n_items, bad, last, list(chunks)


class BatchAssembler(StatefulProcessor):
    """Holds the rows of the batches of a group until as many have come as a batch has, then releases all or none.

    Rows wait in the state store in chunks, which are read and written one by one, so a large batch is not held in
    memory; only the counts of a group's open batches are. A chunk is touched when a batch in it is settled, and a batch
    with many rows has chunks of its own. Batches that come whole never enter the state. With ``timeout_ms`` a batch
    that does not fill up in that time after its last row is refused and forgotten.
    """

    def __init__(self, names: list[str], timeout_ms: int | None):
        self.names = names
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "id bigint", "rows binary")
        self.counts = handle.getValueState("counts", "next bigint, open string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = 0 if self.timeout_ms is None else timerValues.getCurrentProcessingTimeInMs()
        self._load()
        seen, broken, held = set(), set(), []
        for part in rows:
            codes, keys = pd.factorize(part["batch_key"], use_na_sentinel=False)
            keys = [None if pd.isna(k) else k for k in keys]
            n, bad = np.bincount(codes), np.bincount(codes, part["bad"])
            n_items = part["n_items"].groupby(codes).max()
            for k, batch in enumerate(keys):
                known = self.open.setdefault(batch, Open())
                if bad[k] and not known.bad:
                    broken.add(batch)
                known.n, known.n_items, known.bad = known.n + int(n[k]), max(known.n_items, int(n_items[k])), known.bad + int(bad[k])
                known.last = now
            seen.update(keys)
            fine = np.array([not self.open[batch].bad for batch in keys])
            long = fine & (n * 8 >= RELEASE_ROWS)
            for k in np.flatnonzero(long):
                self._store(part[codes == k])
            held.append(part[(fine & ~long)[codes]])
            if sum(map(len, held)) >= RELEASE_ROWS:
                self._store(pd.concat(held))
                held = []
        whole = {batch for batch in seen if self.open[batch].n >= self.open[batch].n_items}
        yield from self._settle({b for b in whole if not self.open[b].bad}, whole | broken, held)
        for batch in broken:
            self.open[batch].chunks = []
        self._save(whole)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._load()
        late = {b for b, known in self.open.items() if known.last + self.timeout_ms <= expiredTimerInfo.getExpiryTimeInMs()}
        yield from self._settle(set(), late, [])
        self._save(late)

    def _settle(self, released: set, gone: set, held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows of the ``released`` batches, from the state and those ``held``; those of the ``gone`` leave the state."""
        for at in sorted({c for batch in gone for c in self.open[batch].chunks}):
            rows = pa.ipc.open_stream(self.chunks.getValue((at,))[0]).read_pandas()
            out, rest = self._apart(rows, released, gone)
            if len(rest):
                self.chunks.updateValue((at,), (self._packed(rest),))
            else:
                self.chunks.removeKey((at,))
            if len(out):
                yield out
        if held:
            out, rest = self._apart(pd.concat(held), released, gone)
            if len(rest):
                self._store(rest)
            if len(out):
                yield out

    def _apart(self, rows: pd.DataFrame, released: set, gone: set) -> tuple[pd.DataFrame, pd.DataFrame]:
        codes, keys = pd.factorize(rows["batch_key"], use_na_sentinel=False)
        keys = [None if pd.isna(k) else k for k in keys]
        out, lost = (np.array([k in some for k in keys], bool)[codes] for some in (released, gone))
        return rows.loc[out, self.names], rows[~lost]

    def _store(self, rows: pd.DataFrame) -> None:
        self.chunks.updateValue((self.next,), (self._packed(rows),))
        for batch in rows["batch_key"].unique():
            self.open[None if pd.isna(batch) else batch].chunks.append(self.next)
        self.next += 1

    def _packed(self, rows: pd.DataFrame) -> bytes:
        schema = pa.schema([(n, pa.string()) for n in ("batch_key", *self.names)])
        table, sink = pa.Table.from_pandas(rows[schema.names], schema, preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()

    def _load(self) -> None:
        self.next, text = self.counts.get() if self.counts.exists() else (0, "[]")
        self.open = {batch: Open(*known) for batch, *known in json.loads(text)}

    def _save(self, gone: set) -> None:
        for batch in gone:
            del self.open[batch]
        if self.open:
            self.counts.update((self.next, json.dumps([[b, k.n, k.n_items, k.bad, k.last, k.chunks] for b, k in self.open.items()])))
        else:
            self.counts.clear()
        if self.timeout_ms is not None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            if self.open:
                self.handle.registerTimer(min(known.last for known in self.open.values()) + self.timeout_ms)

    def close(self) -> None:
        pass


def whole_batches(checked: DataFrame, columns: str = COLUMNS, timeout_ms: int | None = None) -> DataFrame:
    """Stream of the rows of batches without a bad row; every batch comes whole or not at all.

    ``checked`` has ``batch_id``, ``n_items`` (rows of the batch, the same in all of them), ``error`` and ``columns``.
    A batch may be spread over any number of micro-batches. A row with a NULL batch is a batch of its own. Batches are
    dealt into ``GROUPS`` groups, fixed at the first start of a stream. The state holds open batches only; without
    ``timeout_ms`` one that never fills up stays. Needs the RocksDB state store.
    """
    schema = StructType.fromDDL(columns)
    alone = F.col("batch_id").isNull()
    key = F.when(alone, F.concat(F.lit("row "), F.col("seq"))).otherwise(F.col("batch_id").cast("string"))
    n_items = F.when(alone, 1).otherwise(F.col("n_items")).cast("bigint")
    # As texts, since pandas has neither a missing integer nor a missing number beside NaN.
    texts = [F.col(f"`{n}`").cast("string").alias(n) for n in schema.names]
    keyed = checked.select(key.alias("batch_key"), n_items.alias("n_items"), F.col("error").isNotNull().cast("int").alias("bad"), *texts)
    dealt = keyed.withColumn("__batch_group", F.pmod(F.xxhash64("batch_key"), F.lit(GROUPS)))
    released = dealt.groupBy("__batch_group").transformWithStateInPandas(
        BatchAssembler(schema.names, timeout_ms),
        StructType([StructField(n, StringType()) for n in schema.names]),
        "append",
        "none" if timeout_ms is None else "processingTime",
    )
    return released.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
