"""The batch runs of the reference, as one object per set of film tables.

``FilmPipeline`` holds the typed tables and builds every job from them. The
intermediates used by several jobs (credits M1, the movie x cast rows of
M10, the three serving tables) are materialized once in the shared
checkpoint folder, so no job recomputes the four-way credit join.

``write_statistics`` is the reference's statistics run (three statistics
and three marts); ``write_ml`` is its ML run (one CSV, ``;``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinespark.operators.latest import last_by
from cinespark.operators.paging import PageIndex
from cinespark.plans import facets, features, marts
from cinespark.plans.catalog import FilmTables
from cinespark.plans.cube import facet_cube
from cinespark.session import StoredTogether, materialize
from cinespark.sources import serving as sv
from cinespark.sources.sinks import csv_sink, parquet_sink
from cinespark.sources.tsv import ORDINAL


class FilmPipeline:
    def __init__(self, tables: FilmTables, as_of_year: int | None = None,
                 actor_min: int = features.ACTOR_MIN, director_min: int = features.DIRECTOR_MIN,
                 since: int = features.SINCE_YEAR,
                 serving_actor_min: int = sv.SERVING_MIN_FILMS,
                 serving_director_min: int = sv.SERVING_MIN_FILMS):
        self.tables = tables
        self.as_of_year = as_of_year
        self.actor_min, self.director_min, self.since = actor_min, director_min, since
        self.serving_actor_min, self.serving_director_min = serving_actor_min, serving_director_min

    # ---------------------------------------------------------- shared parts
    @cached_property
    def credits(self) -> DataFrame:
        """M1 as a Parquet table in the shared folder: read by M7, M8, M9 and
        the serving tables."""
        return materialize(marts.credits_base(self.tables, as_of_year=self.as_of_year),
                           "credits", sort_within=["nconst"])

    @cached_property
    def movies(self) -> DataFrame:
        """M2 without the final order, stored: read by M10 and the film mart."""
        return materialize(marts.movie_genre(self.tables, ordered=False), "movie_genre")

    @cached_property
    def cast(self) -> DataFrame:
        """M9, stored."""
        return materialize(features.cast_distribution(self.credits, self.actor_min, self.director_min,
                                                      self.since), "cast")

    @cached_property
    def movie_cast(self) -> DataFrame:
        """M10, stored: read by both layouts of the ML matrix."""
        return materialize(features.movie_cast(self.movies, self.cast), "movie_cast")

    @cached_property
    def movie_mart(self) -> DataFrame:
        """M6 with NULLs, stored."""
        return materialize(marts.movie_mart(self.tables, fill=False), "movie_mart", sort_within=["decade", "genre"])

    @cached_property
    def actor_mart(self) -> DataFrame:
        """M7 with NULLs, stored."""
        return materialize(marts.actor_mart(self.credits), "actor_mart", sort_within=["nb_film"])

    @cached_property
    def director_mart(self) -> DataFrame:
        """M8 with NULLs, stored."""
        return materialize(marts.director_mart(self.credits), "director_mart", sort_within=["nb_film"])

    def scan_movies(self) -> DataFrame:
        return marts.fill_missing(sv.serving_scan_movie(self.movie_mart))

    def scan_actors(self) -> DataFrame:
        return marts.fill_missing(sv.serving_scan_actor(self.actor_mart, self.serving_actor_min))

    def scan_directors(self) -> DataFrame:
        return marts.fill_missing(sv.serving_scan_director(self.director_mart, self.serving_director_min))

    @cached_property
    def serving(self) -> sv.Serving:
        """The three serving tables, stored (the dashboard's snapshot) when a
        view first reads them; rows with a NULL are dropped here, once."""
        kept = StoredTogether(
            {"serving_movie": lambda: self.scan_movies().na.drop(), "serving_actor": lambda: self.scan_actors().na.drop(),
             "serving_director": lambda: self.scan_directors().na.drop()}, "tconst", "decade",
            {"serving_movie": ["genre"], "serving_actor": ["Nconst"], "serving_director": ["Nconst"]})
        return sv.Serving(movies=lambda: kept["serving_movie"], actors=lambda: kept["serving_actor"],
                          directors=lambda: kept["serving_director"], cube=lambda: self.cube, names=lambda: self.person_names)

    @cached_property
    def cube(self) -> DataFrame:
        """The facet cube of the films, stored."""
        return materialize(facet_cube(self.serving.movies), "facet_cube")

    @cached_property
    def person_names(self) -> DataFrame | None:
        """(Nconst, name): the name in each person's last source row, if the rows carry their place in the source."""
        people = self.tables.name_basics
        if ORDINAL not in people.columns:
            return None
        return materialize(last_by(people.select(F.col("nconst").alias("Nconst"), F.col("primaryName").alias("name"), ORDINAL),
                                   ["Nconst"], ["name"], ORDINAL), "person_names")

    @cached_property
    def name_vocabulary(self) -> DataFrame:
        """Person features with their columns in the ML matrix, stored."""
        return materialize(features.feature_vocabulary(self.movie_cast, "name"), "name_vocabulary")

    @cached_property
    def film_pages(self) -> PageIndex:
        """The film table with the place of every row, stored by blocks of pages."""
        return facets.film_pages(self.serving)

    # ---------------------------------------------------------- job results
    def statistics(self) -> dict[str, DataFrame]:
        """The six outputs of the statistics run, NULLs kept."""
        return {
            "stat_global": marts.stat_global(self.tables),
            "stat_gen_genre": marts.genre_stats(self.tables),
            "stat_gen_content": marts.content_share(self.tables),
            "movie": self.movie_mart,
            "actor": self.actor_mart,
            "producer": self.director_mart,
        }

    def ml_matrix(self, genres: list[str]) -> DataFrame:
        """The ML matrix over a given list of genre features; people as places in ``name_vocabulary``."""
        return features.ml_onehot(self.movie_cast, genres, names=self.name_vocabulary)

    # ---------------------------------------------------------- sinks
    def write_statistics(self, path: str, fmt: str = "csv") -> dict[str, str]:
        """Write every output under ``path``; CSV with decimal comma, -9999
        for missing cells and the running index, or Parquet with NULLs."""
        out = {}
        small = {"stat_global", "stat_gen_genre", "stat_gen_content"}
        for name, df in self.statistics().items():
            p = f"{path.rstrip('/')}/{name}"
            if fmt == "csv":
                csv_sink(df, p, sep=",", single_file=name in small, index_by=df.columns[:1])
            else:
                parquet_sink(df, p, range_key="tconst" if name == "movie" else None)
            out[name] = p
        return out

    def write_ml(self, path: str, name: str = "df_movie", genres: list[str] | None = None) -> str:
        """The ML matrix as CSV with ``;`` and the running index: the long
        layout, or the wide one over the genre features ``genres``, whose
        person columns are listed in ``{name}_columns``."""
        p = f"{path.rstrip('/')}/{name}"
        if genres:
            df = self.ml_matrix(genres).withColumn("name_indices", F.array_join("name_indices", ","))
            csv_sink(self.name_vocabulary, f"{p}_columns", sep=";", sort_within=["idx"])
        else:
            df = features.ml_onehot_long(self.movie_cast)
        csv_sink(df, p, sep=";", decimal_comma=False, fill=bool(genres), index_by=["tconst"])
        return p
