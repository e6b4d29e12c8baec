"""Stored facet cube: counts and sums by genre, decade and floored rating.

The means of D2-D5 are sums over counts, and sums of groups add up, so a view
without a person selection needs no film rows: it filters and adds up the
rows of one grouping set of the cube, whose size is bounded by the facets and
not by the films. The rating is summed as a decimal, so the order of adding
does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACETS = ["genre", "decade", "note"]
#: The stored combinations; a view takes the first that has all its facets.
SETS = [[], ["genre"], ["decade"], ["genre", "note"], ["decade", "note"], ["genre", "decade"], FACETS]
MEASURES = ["averagerating", "numvotes", "runtimeminutes"]


def _level(facets) -> int:
    """``grouping_id`` of a set: a bit for each facet that is summed over."""
    return sum(1 << (len(FACETS) - 1 - k) for k, f in enumerate(FACETS) if f not in facets)


def facet_cube(movies: DataFrame) -> DataFrame:
    """(genre, decade, note, level, n, and the sum of each measure) of film x genre rows without NULLs."""
    rows = movies.select("genre", "decade", F.floor("averagerating").cast("int").alias("note"),
                         F.col("averagerating").cast("decimal(28,10)").alias("averagerating"), "numvotes", "runtimeminutes")
    return rows.groupingSets([[F.col(c) for c in s] for s in SETS], *FACETS).agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in MEASURES])


def cube_rows(cube: DataFrame, by: Sequence[str], genres=None, decades=None, notes=None) -> DataFrame:
    """The rows of the smallest grouping set that has the facets ``by`` and those filtered on."""
    chosen = {f: v for f, v in zip(FACETS, (genres, decades, notes)) if v}
    level = _level(next(s for s in SETS if set(s) >= set(by) | set(chosen)))
    keep = reduce(lambda a, b: a & b, [F.col(f).isin(list(v)) for f, v in chosen.items()], F.col("level") == level)
    return cube.filter(keep)


def cube_mean(measure: str):
    return F.sum(measure).cast("double") / F.sum("n")
