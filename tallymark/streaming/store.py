"""Durable metric state fed by micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark import schema as S
from tallymark.operators.fold import add_deltas, fold_state
from tallymark.sources.files import Versions


class StateStore:
    """State as full versions plus the folded rows of the epochs after them.

    An epoch writes only its own folded rows, so its cost follows the micro-batch and not the
    state; every ``compact_every`` epochs one fold writes a new full version. An epoch that was
    applied before is skipped, which makes replays harmless. What the last two full versions replace is then deleted,
    so the folder does not grow with the age of the stream. Readers fold the newest full version
    with the epochs after it; conditions on type and name reach the scans.

    Counters of an epoch are added to the state, or with ``add=False`` replace it (for epochs that
    bring running totals). One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, compact_every: int = 20, overflow: str = "error", add: bool = True):
        root = root.rstrip("/")
        self.full = Versions(spark, f"{root}/full", S.STATE)
        self.deltas = Versions(spark, f"{root}/delta", S.STATE)
        self.compact_every = compact_every
        self.overflow = overflow
        self.add = add

    def _layout(self) -> tuple[list[int], list[int]]:
        full = self.full.complete()[-1:]
        return full, [d for d in self.deltas.complete() if not full or d > full[0]]

    def applied(self) -> int:
        """Newest applied epoch, -1 for none."""
        full, deltas = self._layout()
        return max(full + deltas, default=-1)

    def is_new(self) -> bool:
        return self._layout() == ([], [])

    def read(self) -> DataFrame:
        full, deltas = self._layout()
        state = self.full.read(full)
        return state.drop("version") if not deltas else self._fold(state.unionByName(self.deltas.read(deltas)))

    def _fold(self, rows: DataFrame) -> DataFrame:
        total = add_deltas(F.col("delta"), self.overflow) if self.add else F.max_by("delta", "version")
        return rows.groupBy(*S.KEY).agg(
            F.max_by("value", "version").alias("value"),
            total.alias("delta"),
            F.min("created_at").alias("created_at"),
            F.max("updated_at").alias("updated_at"),
        )

    def apply(self, updates: DataFrame, epoch: int, order: str = "seq", ts: str = "ts") -> bool:
        """Fold and apply the valid updates of one epoch; False when it was applied before."""
        timed = updates.withColumn(ts, F.col(ts).cast("timestamp_ntz"))
        return self.put(fold_state(timed, order, self.overflow, ts), epoch)

    def put(self, folded: DataFrame, epoch: int) -> bool:
        """Apply rows that are folded already, one per key."""
        full, deltas = self._layout()
        if epoch <= max(full + deltas, default=-1):
            return False
        self._write(self.deltas, folded, epoch)
        if len(deltas) + 1 >= self.compact_every:
            self.compact()
            self.expire()
        return True

    def compact(self) -> None:
        epoch = self.applied()
        if epoch >= 0:
            # by ranges, so that a point lookup opens the one file that may hold its key
            self._write(self.full, self.read().repartitionByRange(*S.KEY), epoch)

    def expire(self, keep: int = 2) -> None:
        """Delete what lies before the newest ``keep`` full versions."""
        kept = self.full.complete()[-keep:]
        if kept:
            self.full.delete_before(kept[0])
            self.deltas.delete_before(kept[0] + 1)

    def restore(self, snapshot: DataFrame, ts: Column) -> None:
        """Make a loaded snapshot the first version of a new store."""
        if not self.is_new():
            raise RuntimeError("restore needs an empty store")
        rows = snapshot.groupBy("type", F.col("id").alias("name")).agg(
            F.max_by("value", "pos").alias("value"), F.max_by("delta", "pos").alias("delta")
        )
        self._write(self.full, rows.withColumns({"created_at": ts, "updated_at": ts}), -1)

    @staticmethod
    def _write(versions: Versions, rows: DataFrame, number: int) -> None:
        # A folder per kind prunes scans of one kind; sorted names let the min/max statistics of
        # row groups and pages prune a point lookup.
        versions.write(rows.sortWithinPartitions(*S.KEY), number, ("type",))
