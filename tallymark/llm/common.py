"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallymark.session import shared_dir

#: Rows that Python functions see at a time, so that lists of long texts stay small.
SLICE = 1024
#: The white space that separates words; other Unicode spaces belong to words.
SPACES = b" \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so that a lost executor loses nothing."""
    shared_dir(df.sparkSession, "llm")  # a local session without the setting gets a folder of its own
    return df.checkpoint()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: Spark then knows its true size and broadcasts it only if that is small."""
    path = shared_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Lists = dict[str, list]


def _lists(batch: pa.RecordBatch, needs: list[str]) -> Lists:
    """Columns as lists; strings as their UTF-8 bytes."""
    cols = {name: batch.column(batch.schema.get_field_index(name)) for name in needs}
    return {k: (c.cast(pa.binary()) if pa.types.is_string(c.type) else c).to_pylist() for k, c in cols.items()}


def _batch(made: Lists, schema: pa.Schema, before: list[pa.Array] = ()) -> pa.RecordBatch:
    fresh = [pa.array(made[f.name], f.type) for f in list(schema)[len(before) :]]
    return pa.RecordBatch.from_arrays([*before, *fresh], schema=schema)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def add_columns(df: DataFrame, needs: list[str], fn: Callable[[Lists], Lists], added: str, drop: tuple[str, ...] = (), per_task: bool = False) -> DataFrame:
    """``df`` with the columns ``added`` (DDL), which ``fn`` makes from the columns it ``needs``, batch by batch.

    Input columns named like an added one are replaced, those in ``drop`` left out. The others pass through.
    With ``per_task``, ``fn`` is called without arguments where a partition starts and returns the function to apply.
    """
    fresh = T.StructType.fromDDL(added)
    kept = [f for f in df.schema if f.name not in fresh.names and f.name not in drop]
    out = T.StructType([*kept, *fresh])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = fn() if per_task else fn
        for batch in _slices(batches):
            before = [batch.column(batch.schema.get_field_index(f.name)).cast(arrow.field(i).type) for i, f in enumerate(kept)]
            yield _batch(apply(_lists(batch, needs)), arrow, before)

    return df.mapInArrow(run, out)


def flat_map(df: DataFrame, fn: Callable[[Iterator[Lists]], Iterator[Lists]], schema: str) -> DataFrame:
    """Rows of ``schema`` (DDL) that ``fn`` makes from all batches of a partition in turn."""
    out = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in fn(_lists(batch, batch.schema.names) for batch in _slices(batches)):
            yield _batch(made, arrow)

    return df.mapInArrow(run, out)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))
