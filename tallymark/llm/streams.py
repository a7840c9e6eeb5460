"""Queues of documents over all partitions: where in its queue each document starts."""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import written


class Marks:
    """Partition, and each row's start in its queue within the partition; one instance per task."""

    def __init__(self):
        self.part = TaskContext.get().partitionId()
        self.at: dict = {}

    def start(self, queue, size: int) -> int:
        at = self.at.get(queue, 0)
        self.at[queue] = at + size
        return at


def placed(rows: DataFrame, queue: str, size: str, label: str) -> DataFrame:
    """``rows`` with ``base``: the size of their queue in all partitions before their own.

    ``rows`` must be stored, with a column ``part`` that numbers partitions. Sizes are summed per partition and queue
    first, so the running sum sees one row per partition; the table of bases is written out, so that Spark knows its
    size, broadcasts it only while it is small and joins it by key beyond that. Null is a queue of its own.
    """
    totals = rows.groupBy("part", queue).agg(F.sum(size).alias("total"))
    before = Window.partitionBy(queue).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("part").alias("__part"), F.col(queue).alias("__queue"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    bases = written(bases, label)
    return rows.join(bases, (rows["part"] == bases["__part"]) & rows[queue].eqNullSafe(bases["__queue"])).drop("__part", "__queue")
