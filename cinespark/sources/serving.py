"""Serving tables: predicate scans of the marts (job S3).

The dashboard reads three marts with fixed predicates. The stored marts keep
NULL for a missing cell, so the predicates below are plain comparisons that
reach the Parquet scan; -9999 is put in afterwards (``fill_missing``). A
database copy of the marts is read with ``read_jdbc_serving``, which hands a
predicate to the database (written, but not tested: no database here).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's serving threshold.
SERVING_MIN_FILMS = 10


def serving_scan_movie(movie_mart: DataFrame) -> DataFrame:
    """Films with a decade, a genre, a runtime and a rating."""
    return movie_mart.filter((F.col("decade") > 0) & F.col("genre").isNotNull()
                             & (F.col("runtimeminutes") > 0) & (F.col("averagerating") > 0))


def serving_scan_actor(actor_mart: DataFrame, min_films: int = SERVING_MIN_FILMS) -> DataFrame:
    """Credits of actors with more than ``min_films`` credits and a known age."""
    return actor_mart.filter((F.col("nb_film") > min_films) & (F.col("age") > 0) & (F.col("age_in_movie") > 0))


def serving_scan_director(director_mart: DataFrame, min_films: int = SERVING_MIN_FILMS) -> DataFrame:
    """Credits of directors with more than ``min_films`` credits and a known age."""
    return director_mart.filter((F.col("nb_film") > min_films) & (F.col("age") > 0))


def read_jdbc_serving(spark: SparkSession, url: str, table: str, predicate: str,
                      properties: dict | None = None, partition_column: str | None = None,
                      lower_bound: int | None = None, upper_bound: int | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """Read ``SELECT * FROM table WHERE predicate`` from a database.

    Give ``partition_column`` (a numeric column) with bounds and a partition
    count to read in parallel ranges instead of one connection.
    """
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("dbtable", f"(SELECT * FROM {table} WHERE {predicate}) AS s")
                  .option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions))
    else:
        reader = reader.option("query", f"SELECT * FROM {table} WHERE {predicate}")
    return reader.load()


@dataclass
class Serving:
    """The three serving tables of the dashboard; the facet cube of the films
    and the people's names by their last source row, where they are known.
    A function in place of a table is called whenever the table is read."""

    movies: DataFrame | Callable[[], DataFrame]
    actors: DataFrame | Callable[[], DataFrame]
    directors: DataFrame | Callable[[], DataFrame]
    cube: DataFrame | Callable[[], DataFrame] | None = None
    names: DataFrame | Callable[[], DataFrame | None] | None = None

    def __getattribute__(self, name):
        value = super().__getattribute__(name)
        return value() if name in _TABLES and callable(value) else value


_TABLES = frozenset(f.name for f in fields(Serving))
