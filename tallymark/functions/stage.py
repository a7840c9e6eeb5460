"""Evaluating costly expressions once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that stay computed where they are.

    Filters on a projected column are pushed below the projection with its expression copied into
    them, so a parse would run once for the filter and again for the column. These columns leave a
    one-row generator instead, which filters on them do not pass.
    """
    one = F.struct(*[c.alias(name) for name, c in columns.items()])
    return rows.select("*", F.inline(F.array(one)))
