"""Explode of multi-value text, and one-hot pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinespark.functions.columns import genre_items


def explode_items(df: DataFrame, source: str, out: str, max_items: int = 3) -> DataFrame:
    """One row per item among the first ``max_items`` of a comma list.

    Replaces a UNION of one SELECT per item position: one scan instead of
    one per branch. Rows whose list is NULL produce nothing.
    """
    return df.withColumn(out, F.explode(genre_items(source, max_items)))


def one_hot(df: DataFrame, keys: list[str], value_col: str, values: list[str],
            *more: Column) -> DataFrame:
    """One row per ``keys``; one 0/1 int column for each of ``values``, then
    the aggregates ``more``.

    The list of values is the output width, so it is a parameter. A value
    outside it is an error; NULL is no value.
    """
    v = F.col(value_col)
    known = F.when(v.isNull() | v.isin(list(values)), v).otherwise(
        F.raise_error(F.concat(F.lit(f"{value_col} is not in the vocabulary: "), v)))
    return (df.withColumn("__value", known).groupBy(*keys)
            .agg(*[F.max(F.when(F.col("__value") == x, 1).otherwise(0)).alias(x) for x in values], *more))
