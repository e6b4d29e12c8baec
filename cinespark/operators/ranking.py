"""Dense rank without a single-partition window over all rows.

``DENSE_RANK() OVER (ORDER BY v DESC)`` with no PARTITION BY moves every row
into one task. A dense rank depends only on the set of distinct values, so we
rank the distinct (partition, value) pairs and join the rank back. If there
are k distinct values in a partition, at least 1 + 2 + ... + k rows carry
them when the value is a per-key count, so k <= sqrt(2 * rows): the ranked
set is tiny next to the rows and is broadcast. Joining it by shuffle would
put every row holding the most common value (a count of 1) in one task.
Callers pass per-key counts (``nb_film``), which is where the bound holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    return left.join(r, cond, "inner").drop(*[f"__r_{k}" for k in keys])


def dense_rank_desc(df: DataFrame, value_col: str, partition_cols: list[str] | tuple = (),
                    rank_col: str = "rank", counts: bool = False) -> DataFrame:
    """Attach the dense rank of ``value_col`` (largest first) within
    ``partition_cols`` to every row of ``df``.

    ``counts=True`` states that the values are per-key counts, which bounds
    the ranked set (see above) and allows the broadcast; with other values
    the join is left to AQE, which broadcasts only what measures small.
    """
    keys = list(partition_cols) + [value_col]
    ranked = (df.select(*keys).distinct()
              .withColumn(rank_col, F.dense_rank().over(
                  Window.partitionBy(*partition_cols).orderBy(F.col(value_col).desc()))))
    return _null_safe_join(df, F.broadcast(ranked) if counts else ranked, keys)
