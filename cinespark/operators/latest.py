"""Distinct by key, keep the last row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_by(df: DataFrame, keys: list[str], values: list[str], ordinal: str) -> DataFrame:
    """One row per key with the ``values`` of the row whose ``ordinal`` is greatest.

    A partial aggregate: each task keeps one row per key, so a hot key costs
    nothing in the shuffle. The ordinal orders the rows of a key; equal ones
    (which a source ordinal never has) go by the values.
    """
    last = F.max(F.struct(ordinal, *values)).alias("__last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col("__last")[v].alias(v) for v in values])
