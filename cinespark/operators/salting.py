"""Equi-joins whose left side may hold a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """``left.join(right, keys, how)`` with the rows of each left key dealt to
    ``salts`` parts by their hash and the right rows repeated for each part.

    A key that holds a third of all left rows meets its match in ``salts``
    tasks whatever the session settings are. The right side should be narrow
    (one row per key, such as counts): it is repeated ``salts`` times. The
    repeated rows are shuffled and merged: they shrink so well on their way
    that AQE would take them for small and broadcast them whole.
    """
    dealt = left.withColumn("__salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    repeated = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return dealt.join(repeated, [*keys, "__salt"], how).drop("__salt")
