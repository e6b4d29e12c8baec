"""Group counts put back on every row, and shares of a total.

``COUNT(*) OVER (PARTITION BY k)`` buffers a whole group in one task; a hot
key (one person with a third of all credits) then sits in one task. Here the
count is a ``groupBy`` with map-side partial aggregation, so the hot key is
one row per map task before the shuffle, and the join back deals the rows
of a key to several tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinespark.operators.salting import salted_join


def with_group_count(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add ``name`` = rows sharing ``keys``; NULL when any key is NULL
    (groups with a missing key are not counted, as in a pandas transform)."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.filter(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return salted_join(df, counts, keys, "left")


def share_of_total(counts: DataFrame, count_col: str, out_col: str = "percent",
                   scale: float = 100.0) -> DataFrame:
    """``count / sum(count) * scale`` on an already aggregated frame.

    The input has one row per group, so the total over it is cheap; the
    per-row division never sees the raw rows.
    """
    total = F.sum(count_col).over(Window.partitionBy())
    return counts.withColumn(out_col, F.col(count_col) / total * F.lit(scale))
