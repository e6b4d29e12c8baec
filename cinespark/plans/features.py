"""Prolific people per film and the ML feature tables (jobs M9-M11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinespark.functions import columns as C
from cinespark.operators.counting import with_group_count
from cinespark.operators.numbering import with_dense_index
from cinespark.operators.reshape import one_hot
from cinespark.operators.salting import salted_join
from cinespark.plans.marts import ACTING, DIRECTING

# Reference thresholds of the ML run.
ACTOR_MIN = 30
DIRECTOR_MIN = 12
SINCE_YEAR = 1970

ML_KEYS = ["tconst", "primarytitle", "originaltitle", "genres", "startyear", "decade",
           "runtimeminutes", "averagerating", "numvotes"]
CAST_COLUMNS = ["tconst", "primaryName", "primaryTitle", "originalTitle", "genres",
                "startYear", "decade", "runtimeMinutes", "averageRating", "numVotes", "genre"]


def cast_distribution(credits: DataFrame, actor_min: int = ACTOR_MIN,
                      director_min: int = DIRECTOR_MIN, since: int = SINCE_YEAR) -> DataFrame:
    """Credits of prolific people in films after ``since`` (M9).

    ``nb_film`` counts all kept credit rows of the person after ``since``
    (actor, actress and director together); actor/actress rows need
    ``nb_film >= actor_min``, director rows ``>= director_min``. One row per
    credit, not distinct.
    """
    rows = credits.filter(F.col("startYear") > since).select(
        "nconst", "tconst", "primaryName", "category")
    counted = with_group_count(rows, ["nconst"], "nb_film")
    cat = F.col("category")
    keep = ((cat.rlike(f"({ACTING})") & (F.col("nb_film") >= actor_min))
            | (cat.rlike(DIRECTING) & (F.col("nb_film") >= director_min)))
    return counted.filter(keep).select("tconst", "primaryName", "nb_film")


def movie_cast(movies: DataFrame, cast: DataFrame) -> DataFrame:
    """Film x genre rows with each prolific person of the film (M10).

    A film without one keeps one row per genre with a NULL name. Written as
    inner join + anti join on distinct ids (the same rows as a left join): on
    stored inputs both sides of the inner join are plain shuffles, so a very
    hot film is split on either side.
    """
    people = cast.select("tconst", "primaryName")
    matched = movies.join(people, "tconst", "inner")
    alone = (movies.join(people.select("tconst").distinct(), "tconst", "left_anti")
             .withColumn("primaryName", F.lit(None).cast("string")))
    return matched.select(*CAST_COLUMNS).unionByName(alone.select(*CAST_COLUMNS))


def _ml_rows(movie_cast_rows: DataFrame) -> DataFrame:
    """Lower-case names, the sentinel as NULL, and the two feature names."""
    text = {"tconst", "primaryTitle", "originalTitle", "genres", "genre", "primaryName"}
    rows = movie_cast_rows.select(*[
        (C.sentinel_to_null(c) if c in text else F.col(c)).alias(c) for c in CAST_COLUMNS])
    rows = rows.toDF(*[c.lower() for c in rows.columns])
    return (rows.withColumn("genre_feature", C.feature_name("genre"))
            .withColumn("name_feature", C.feature_name("primaryname")))


def _keys_known(df: DataFrame) -> DataFrame:
    """Films with every key known (the others leave the ML set)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ML_KEYS]))


def feature_vocabulary(movie_cast_rows: DataFrame, kind: str = "name") -> DataFrame:
    """(feature, idx): every feature of a kind with its dense place 0, 1, ...
    in code point order, which is the column it has in the matrix.

    As in the reference the columns come from all rows, also those of films
    that leave the set for an unknown key. The vocabulary stays a table: it
    grows with the people and never reaches the driver.
    """
    feature = F.col(f"{kind}_feature").alias("feature")
    known = _ml_rows(movie_cast_rows).select(feature).where(F.col("feature").isNotNull()).distinct()
    return with_dense_index(known, [F.col("feature").asc()], "idx")


def _with_index(rows: DataFrame, vocabulary: DataFrame, kind: str) -> DataFrame:
    """Rows with the place ``{kind}_idx`` of their feature; a feature in a third of all rows is dealt out."""
    places = vocabulary.select(F.col("feature").alias(f"{kind}_feature"), F.col("idx").alias(f"{kind}_idx"))
    return salted_join(rows, places, [f"{kind}_feature"], "left")


def ml_sparse(movie_cast_rows: DataFrame, vocabulary: DataFrame, kind: str = "name") -> DataFrame:
    """One row per film with its 0/1 vector in sparse form (M11b): the nine
    keys, ``indices`` (ascending places in the vocabulary) and ``values``
    (a 1 for each). A film without a feature has empty arrays."""
    pairs = _keys_known(_ml_rows(movie_cast_rows)).select(*ML_KEYS, f"{kind}_feature").distinct()
    return (_with_index(pairs, vocabulary, kind).groupBy(*ML_KEYS)
            .agg(F.array_sort(F.collect_list(f"{kind}_idx")).alias("indices"))
            .withColumn("values", F.transform("indices", lambda i: F.lit(1).cast("tinyint"))))


def ml_onehot(movie_cast_rows: DataFrame, genres: list[str], names: DataFrame | None = None) -> DataFrame:
    """One row per film (9 keys) with one 0/1 column for each genre feature
    of the list ``genres`` (M11a), and with the vocabulary ``names`` the
    person columns of the film as ``name_indices`` (M11c).

    Genres and names are encoded separately. A genre outside the list is an
    error. The person columns stay sparse: their number grows with the people.
    """
    rows, more = _keys_known(_ml_rows(movie_cast_rows)), []
    if names is not None:
        rows = _with_index(rows, names, "name")
        more = [F.array_sort(F.collect_set("name_idx")).alias("name_indices")]
    return one_hot(rows, ML_KEYS, "genre_feature", genres, *more)


def ml_onehot_long(movie_cast_rows: DataFrame, kinds: tuple[str, ...] = ("genre", "name")) -> DataFrame:
    """The M11 matrix in long (sparse) layout, its main form: one row per
    (film keys, kind, feature) whose column would hold 1, and one row with
    NULLs for a film without any. Its width does not grow with the data and
    no vocabulary is collected."""
    rows = _keys_known(_ml_rows(movie_cast_rows))
    pairs = reduce(DataFrame.unionByName, [
        rows.select(*ML_KEYS, F.lit(k).alias("kind"), F.col(f"{k}_feature").alias("feature")) for k in kinds])
    hits = pairs.where(F.col("feature").isNotNull()).distinct()
    empty = (pairs.groupBy(*ML_KEYS).agg(F.count("feature").alias("_n")).where(F.col("_n") == 0)
             .select(*ML_KEYS, F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("feature")))
    return hits.unionByName(empty)
