"""Named checks. Rows are never dropped by a check: each gets an ``error`` column, NULL when valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark import schema as S
from tallymark.functions.numbers import is_finite, parse_operands
from tallymark.functions.stage import computed_once
from tallymark.session import shared_dir

# Outcomes by number; position + 1 is the code (fixed values).
_VERDICTS = (
    S.UNSUPPORTED_TYPE,
    S.VALUE_REQUIRED,
    S.DELTA_REQUIRED,
    S.NAME_EMPTY,
    S.INVALID_VALUE,
    S.NAME_TOO_LONG,
    S.TYPE_TOO_LONG,
)


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def unsupported(kind: Column) -> Column:
    return ~F.coalesce(kind, F.lit("")).isin(*S.KINDS)


def _too_long(error: Column) -> Column:
    return (
        F.when(error.isNotNull(), error)
        .when(F.length("name") > S.MAX_NAME, F.lit(S.NAME_TOO_LONG))
        .when(F.length("type") > S.MAX_TYPE, F.lit(S.TYPE_TOO_LONG))
    )


def check_text(updates: DataFrame, max_lengths: bool = False) -> DataFrame:
    """Parse ``raw_value`` by ``type`` into ``value`` / ``delta`` and name what is wrong.

    Order of the checks: name, type, operand. ``max_lengths`` adds the relational column widths.
    """
    kind, parsed = F.col("type"), parse_operands(updates)
    error = (
        F.when(blank(F.col("name")), F.lit(S.NAME_EMPTY))
        .when(unsupported(kind), F.lit(S.UNSUPPORTED_TYPE))
        .when(F.col("value").isNull() & F.col("delta").isNull(), F.lit(S.INVALID_VALUE))
    )
    return parsed.withColumn("error", _too_long(error) if max_lengths else error)


def typed_error(kind: Column, name: Column, value: Column, delta: Column) -> Column:
    """Outcome of one typed update: type and operand first, then the name."""
    return (
        F.when(unsupported(kind), F.lit(S.UNSUPPORTED_TYPE))
        .when((kind == S.GAUGE) & value.isNull(), F.lit(S.VALUE_REQUIRED))
        .when((kind == S.COUNTER) & delta.isNull(), F.lit(S.DELTA_REQUIRED))
        .when(blank(name), F.lit(S.NAME_EMPTY))
    )


def check_typed(updates: DataFrame) -> DataFrame:
    """Check typed updates; an operand of the other kind is accepted and set to NULL."""
    c = F.col
    checked = updates.withColumn("error", typed_error(c("type"), c("name"), c("value"), c("delta")))
    return checked.withColumns(
        {
            "value": F.when(c("type") == S.GAUGE, c("value")),
            "delta": F.when(c("type") == S.COUNTER, c("delta")),
        }
    )


def snapshot_error(ident: Column, kind: Column, value: Column, delta: Column) -> Column:
    """Outcome of one snapshot row: exactly the operand of its kind must be set."""
    gauge = (kind == S.GAUGE) & value.isNotNull() & delta.isNull()
    counter = (kind == S.COUNTER) & delta.isNotNull() & value.isNull()
    return (
        F.when(blank(ident), F.lit(S.ID_EMPTY))
        .when(unsupported(kind), F.lit(S.UNSUPPORTED_TYPE))
        .when(~(gauge | counter), F.lit(S.OPERAND_MISMATCH))
    )


def check_snapshot(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.withColumn("error", snapshot_error(c("id"), c("type"), c("value"), c("delta")))


def require(rows: DataFrame, error: Column, label: Column, what: str) -> DataFrame:
    """Pass the rows through, failing the job at the first one whose ``error`` is set.

    The gate is a filter, so it costs no extra pass and column pruning cannot drop it. Its column
    is computed on these very rows: pushed further down it would also see rows that an earlier
    filter takes out.
    """
    message = F.concat(F.lit(f"{what}: "), error, F.lit(" at "), F.coalesce(label.cast("string"), F.lit("?")))
    passed = F.when(error.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return computed_once(rows, passed=passed).where("passed").drop("passed")


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNull()).drop("error")


def rejects(checked: DataFrame) -> DataFrame:
    """Dead letters, with the status each was answered with."""
    bad = checked.where(F.col("error").isNotNull())
    return bad.withColumn("status", status_code(F.col("error")))


def status_code(error: Column) -> Column:
    """Status of an outcome: 200 for none, 500 for one without its own code."""
    code = F.when(error.isNull(), F.lit(S.STATUS_OK))
    for name, status in S.STATUS.items():
        code = code.when(error == name, F.lit(status))
    return code.otherwise(F.lit(S.STATUS_OTHER))


def rejects_by_code(checked: DataFrame) -> DataFrame:
    return rejects(checked).groupBy("error", "status").agg(F.count("*").alias("n"))


def batch_profile(checked: DataFrame) -> DataFrame:
    """Size of every batch, by kind."""
    return checked.groupBy("batch_id").agg(
        F.count("*").alias("n_items"),
        F.count_if(F.col("type") == S.GAUGE).alias("n_gauges"),
        F.count_if(F.col("type") == S.COUNTER).alias("n_counters"),
    )


def batch_verdicts(checked: DataFrame, order: str = "seq") -> DataFrame:
    """The outcome each batch is answered with.

    The first element with a wrong type or operand decides; only without one does the first empty
    name. Outcomes travel as numbers, which keeps this a hash aggregate for any ``order``.
    """
    code = F.lit(None).cast("int")
    for i, name in enumerate(_VERDICTS):
        code = F.when(F.col("error") == name, F.lit(i + 1)).otherwise(code)
    late = F.col("error") == S.NAME_EMPTY
    coded = checked.select("batch_id", order, F.when(~late, code).alias("early"), F.when(late, code).alias("late"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
    found = coded.groupBy("batch_id").agg(F.coalesce(first("early"), first("late")).alias("first"))
    verdict = F.element_at(F.array(*[F.lit(v) for v in _VERDICTS]), F.col("first"))
    return found.select("batch_id", F.when(F.col("first").isNotNull(), verdict).alias("error"))


def drop_rejected_batches(checked: DataFrame, batch: str = "batch_id") -> DataFrame:
    """All-or-nothing batches: keep only the rows of batches without a bad row.

    A row with a NULL batch is a batch of its own: it stays if it is valid.

    The checked rows are written once, so they are parsed once, and so are the ids of bad batches. Their true size
    is then known to the optimizer, which broadcasts them only below ``spark.sql.autoBroadcastJoinThreshold``: the log
    itself is shuffled only when bad batches are too many for that, and then a batch too large for one task is split
    by the adaptive skew join. Streams use ``streaming.batches.whole_batches``.
    """
    spark = checked.sparkSession
    rows = _written(spark, checked, "checked")
    bad = rows.where(F.col("error").isNotNull() & F.col(batch).isNotNull()).select(batch).distinct()
    return valid(rows.join(_written(spark, bad, "bad-batches"), batch, "left_anti"))


def _written(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    folder = shared_dir(spark, label)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def finite_values(rows: DataFrame) -> Column:
    """Outcome of a value that JSON cannot hold."""
    return F.when(F.col("value").isNotNull() & ~is_finite(F.col("value")), F.lit("not_finite"))
