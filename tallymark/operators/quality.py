"""Quality report: named checks over a table, and their overall status."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OK = "ok"
ERROR = "error"
UNHEALTHY = "unhealthy"
OVERALL = "overall"


def quality_report(rows: DataFrame, violations: dict[str, Column]) -> DataFrame:
    """Rows ``(name, status, error)``: one per check and the ``overall`` status.

    A check is the condition of a row that violates it; all are counted in one pass. Without any
    check the overall status is ``ok``.
    """
    return _report(rows.agg(*_counts(violations)), list(violations))


def _counts(violations: dict[str, Column]) -> list[Column]:
    return [F.count("*").alias("rows_seen"), *[F.count_if(bad).alias(name) for name, bad in violations.items()]]


def _report(counts: DataFrame, names: list[str]) -> DataFrame:
    n = {name: F.col(f"`{name}`") for name in names}
    failed = F.lit(False)
    for count in n.values():
        failed = failed | (count > 0)
    results = [_result(name, count > 0, ERROR, F.concat(count.cast("string"), F.lit(" rows"))) for name, count in n.items()]
    overall = _result(OVERALL, failed, UNHEALTHY, F.lit(None).cast("string"))
    return counts.select(F.inline(F.array(*results, overall)))


def observed(rows: DataFrame, violations: dict[str, Column], observation: Observation | str) -> DataFrame:
    """``rows``, whose violations are counted while something else reads them: no scan of their own.

    A batch passes an ``Observation`` and gives it to ``observed_report`` after the action that read the rows; a stream
    passes a name, and a ``StreamHealth`` of that name keeps the counts of every micro-batch.
    """
    return rows.observe(observation, *_counts(violations))


def observed_report(spark: SparkSession, observation: Observation) -> DataFrame:
    """``quality_report`` of rows that have been read; waits until they are."""
    return counted_report(spark, observation.get)


def counted_report(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``quality_report`` of the counts of one observation."""
    names = [name for name in counts if name != "rows_seen"]
    columns = ", ".join(f"`{name}` bigint" for name in counts)
    return _report(spark.createDataFrame([tuple(counts.values())], columns), names)


class StreamHealth(StreamingQueryListener):
    """Counts of each micro-batch of the streams whose rows are observed under ``name``, newest last.

    Register it with ``spark.streams.addListener``. ``failed`` is called with the micro-batch and its counts as soon as
    one has a violation; the last ``keep`` are remembered.
    """

    def __init__(self, name: str, failed: Callable[[int, dict[str, int]], None] | None = None, keep: int = 1000):
        self.name, self.failed = name, failed
        self.batches: deque[tuple[int, dict[str, int]]] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        counts = row.asDict()
        self.batches.append((event.progress.batchId, counts))
        if self.failed and any(n for name, n in counts.items() if name != "rows_seen"):
            self.failed(event.progress.batchId, counts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _result(name: str, failed: Column, word: str, error: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        F.when(failed, F.lit(word)).otherwise(F.lit(OK)).alias("status"),
        F.when(failed, error).alias("error"),
    )
