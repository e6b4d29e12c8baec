"""Catalogue statistics and the film / credit marts (jobs M1-M8).

Every function takes typed ``FilmTables`` (or a frame built here) and returns
a lazy DataFrame. Plan notes are on each function.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinespark.functions import columns as C
from cinespark.operators.counting import share_of_total
from cinespark.operators.ranking import dense_rank_desc
from cinespark.operators.reshape import explode_items
from cinespark.operators.salting import salted_join
from cinespark.plans.catalog import FilmTables

# The reference's filters and defaults.
REGION = "FR"
TITLE_TYPE = "movie"
MAX_RUNTIME = 60 * 5
CREDIT_CATEGORIES = "(director|actor|actress)"
EXCLUDED_PROFESSIONS = "(cinematographer|miscellaneous)"
ACTING = "actor|actress"
DIRECTING = "director"
EXCLUDED_GENRE = "Adult"


def titles_in_region(t: FilmTables, region: str = REGION) -> DataFrame:
    """Distinct ids of titles with at least one aka row in ``region``.

    ``distinct`` aggregates map-side first, so a title with very many aka
    rows is one row per task before the shuffle. Joining titles to this set
    equals the inner join to the aka rows followed by DISTINCT.
    """
    return (t.title_akas.filter(F.col("region") == region)
            .select(F.col("titleId").alias("tconst")).distinct())


# ---------------------------------------------------------------- M1

def credits_base(t: FilmTables, as_of_year: int | None = None, region: str = REGION,
                 title_type: str = TITLE_TYPE) -> DataFrame:
    """Person x title credits of films in ``region`` (M1).

    Filters: category matches director/actor/actress (unanchored regex),
    profession does not match cinematographer/miscellaneous (a NULL
    profession drops the row, the text sentinel keeps it), title type, not
    adult. DISTINCT over the whole row: one person credited in two
    categories of one film gives two rows. ``as_of_year`` is the current year
    unless given.

    Plan: the type/adult filters reach the title scan; the region becomes a
    semi-join on pre-deduplicated title ids; principals join titles on
    ``tconst`` and people on ``nconst``. DISTINCT is taken of each input
    before the joins (the row holds every column of all three), so no step
    needs the rows of one person together and a hot person is split.
    """
    titles = (t.title_basics
              .filter((F.col("titleType") == title_type) & (F.col("isAdult") == 0))
              .join(titles_in_region(t, region), "tconst", "left_semi")
              .select("tconst", "primaryTitle", "originalTitle", "startYear",
                      "runtimeMinutes", "genres").distinct())
    principals = (t.title_principals
                  .filter(F.col("category").rlike(CREDIT_CATEGORIES))
                  .select("tconst", "nconst", "category").distinct())
    people = (t.name_basics
              .filter(~F.col("primaryProfession").rlike(EXCLUDED_PROFESSIONS))
              .select("nconst", "primaryName", "birthYear", "deathYear", "primaryProfession").distinct())
    rows = principals.join(titles, "tconst").join(people, "nconst")
    return rows.select(
        "nconst", "tconst", "primaryName", "birthYear", "deathYear", "primaryTitle",
        "originalTitle", "startYear", "runtimeMinutes", "genres", "category",
        "primaryProfession",
        C.sexe("category").alias("sexe"),
        C.age("birthYear", "deathYear", as_of_year or date.today().year).alias("age"),
        (F.col("startYear") - F.col("birthYear")).alias("age_in_movie"),
        C.decade("startYear").alias("decade"),
    )


# ---------------------------------------------------------------- M2

MOVIE_COLUMNS = ["tconst", "primaryTitle", "originalTitle", "startYear", "decade",
                 "runtimeMinutes", "genres", "averageRating", "numVotes", "genre"]


def movie_genre(t: FilmTables, region: str = REGION, title_type: str = TITLE_TYPE,
                max_runtime: int = MAX_RUNTIME, ordered: bool = True) -> DataFrame:
    """Rated films in ``region``, one row per film x genre (M2).

    Genre = items 0-2 of the comma list; a NULL item and ``Adult`` go; the
    sentinel genre stays. One explode + DISTINCT replaces the three-branch
    UNION (one scan instead of three). Rows come ordered by ``tconst``: the
    DISTINCT runs in the ``tconst`` partitions of the joins, and the order
    costs one range shuffle.
    """
    titles = (t.title_basics
              .filter((F.col("titleType") == title_type) & (F.col("isAdult") == 0)
                      & (F.col("runtimeMinutes") <= max_runtime))
              .join(titles_in_region(t, region), "tconst", "left_semi")
              .select("tconst", "primaryTitle", "originalTitle", "startYear",
                      "runtimeMinutes", "genres"))
    rated = titles.join(t.title_ratings.select("tconst", "averageRating", "numVotes"), "tconst")
    rows = explode_items(rated.withColumn("decade", C.decade("startYear")), "genres", "genre")
    out = (rows.filter(F.col("genre").isNotNull() & (F.col("genre") != EXCLUDED_GENRE))
           .select(*MOVIE_COLUMNS).distinct())
    return out.orderBy("tconst") if ordered else out


# ---------------------------------------------------------------- M3

def stat_global(t: FilmTables, region: str = REGION, title_type: str = TITLE_TYPE) -> DataFrame:
    """One row: titles, aka rows in region, movies, movie x region-aka rows (M3).

    Counts are of rows (a film with two aka rows in the region counts twice
    in the last column). With no aka row in the region the result is empty.

    Plan: both sides are aggregated per title id first (a title with very
    many aka rows becomes one row), then one full outer join on the id and a
    single global aggregate; no cross join of one-row frames.
    """
    per_title = (t.title_basics.groupBy("tconst").agg(
        F.count("tconst").alias("n_all"),
        F.count(F.when(F.col("titleType") == title_type, F.col("tconst"))).alias("n_movie")))
    per_aka = (t.title_akas.filter(F.col("region") == region)
               .groupBy(F.col("titleId").alias("tconst_r"))
               .agg(F.count("titleId").alias("n_region"), F.lit(1).alias("_aka_group")))
    joined = per_title.join(per_aka, per_title["tconst"] == per_aka["tconst_r"], "full_outer")
    agg = joined.agg(
        F.coalesce(F.sum("n_all"), F.lit(0)).cast("bigint").alias("total_contenu"),
        F.coalesce(F.sum("n_region"), F.lit(0)).cast("bigint").alias("total_contenu_region"),
        F.coalesce(F.sum("n_movie"), F.lit(0)).cast("bigint").alias("total_movie"),
        F.coalesce(F.sum(F.col("n_movie") * F.col("n_region")), F.lit(0))
         .cast("bigint").alias("total_movie_fr"),
        F.count("_aka_group").alias("_aka_groups"),
    )
    return (agg.filter(F.col("_aka_groups") > 0)
            .select("total_contenu", "total_contenu_region", "total_movie", "total_movie_fr"))


# ---------------------------------------------------------------- M4

def genre_stats(t: FilmTables, digits: int = 2) -> DataFrame:
    """Mean runtime, rating and votes per genre over all rated titles (M4).

    Rows are distinct (title, rating, votes, genre, runtime), runtime > 0,
    genre items 0-2; a missing item is no group, the sentinel is one; no type,
    region or adult filter. Means rounded to ``digits``, ordered by genre.
    """
    rows = (t.title_basics.filter(F.col("runtimeMinutes") > 0)
            .select("tconst", "genres", "runtimeMinutes")
            .join(t.title_ratings.select("tconst", "averageRating", "numVotes"), "tconst"))
    items = (explode_items(rows, "genres", "genre")
             .filter(F.col("genre").isNotNull())
             .select("tconst", "averageRating", "numVotes", "genre", "runtimeMinutes")
             .distinct())
    return (items.groupBy("genre").agg(
        F.round(F.avg("runtimeMinutes"), digits).alias("runtimeminutes"),
        F.round(F.avg("averageRating"), digits).alias("averagerating"),
        F.round(F.avg("numVotes"), digits).alias("numvotes"))
        .orderBy("genre"))


# ---------------------------------------------------------------- M5

def content_share(t: FilmTables) -> DataFrame:
    """Percent of distinct titles per title type, largest first (M5).

    The reference divides a per-type window count by a window count over
    everything; here the per-type count is a grouped distinct count and the
    total is summed over the per-type rows only.
    """
    per_type = t.title_basics.groupBy("titleType").agg(
        F.count_distinct("tconst").alias("n"))
    return (share_of_total(per_type, "n", "percent")
            .select("titleType", "percent").orderBy(F.col("percent").desc()))


# ---------------------------------------------------------------- M6

MOVIE_MART_TEXT = ["tconst", "primarytitle", "originaltitle", "genres", "genre"]


def movie_mart(t: FilmTables, fill: bool = True, **kw) -> DataFrame:
    """M2 with lower-case names and the sentinel as NULL (M6).

    ``fill=True`` writes -9999 for every NULL, as the mart file holds it.
    """
    m = movie_genre(t, ordered=False, **kw)
    m = m.toDF(*[c.lower() for c in m.columns])
    m = m.select(*[C.sentinel_to_null(c).alias(c) if c in MOVIE_MART_TEXT else F.col(c)
                   for c in m.columns])
    return fill_missing(m) if fill else m


def fill_missing(df: DataFrame, value: int = C.FILL_VALUE) -> DataFrame:
    """NULL -> ``value`` in every column (text columns get its text)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "string":
            out.append(F.coalesce(F.col(f.name), F.lit(str(value))).alias(f.name))
        elif f.dataType.typeName() in ("integer", "long", "short", "byte", "double", "float"):
            out.append(F.coalesce(F.col(f.name), F.lit(value).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- M7 / M8

PERSON_TEXT = ["primaryName", "primaryTitle", "originalTitle", "genres", "primaryProfession"]
ACTOR_COLUMNS = ["Nconst", "tconst", "primaryName", "birthYear", "deathYear", "primaryTitle",
                 "originalTitle", "startYear", "runtimeMinutes", "genres", "nb_film", "sexe",
                 "age_in_movie", "age", "decade", "rank", "film_per_decade"]
DIRECTOR_COLUMNS = ["Nconst", "tconst", "primaryName", "birthYear", "deathYear",
                    "primaryProfession", "primaryTitle", "originalTitle", "startYear",
                    "runtimeMinutes", "genres", "age_in_movie", "age", "decade", "nb_film",
                    "rank", "film_per_decade"]


def _credit_counts(credits: DataFrame, with_sexe: bool) -> DataFrame:
    """``nb_film`` = credit rows per person: one partial aggregate, so a
    prolific person is one row per task before the shuffle. With
    ``with_sexe`` there is one row per (person, sex code) the person holds;
    the set of codes has at most two values."""
    if not with_sexe:
        return credits.groupBy("nconst").agg(F.count(F.lit(1)).alias("nb_film"))
    return (credits.groupBy("nconst")
            .agg(F.count(F.lit(1)).alias("nb_film"), F.collect_set("sexe").alias("_sexes"))
            .select("nconst", F.explode("_sexes").alias("sexe"), "nb_film"))


def _clean_text(df: DataFrame) -> DataFrame:
    return df.select(*[C.sentinel_to_null(c).alias(c) if c in PERSON_TEXT else F.col(c)
                       for c in df.columns])


def _finish_person_mart(rows: DataFrame, counted: DataFrame, columns: list[str]) -> DataFrame:
    """Sentinel -> NULL and ``film_per_decade``.

    ``counted`` holds the same rows as ``rows`` before the per-person ranks
    were joined on (that join is 1:1), so the name-decade counts come from
    it. The counts are joined null-safe and NULL keys are blanked after: a
    plain equi-join would push inferred IS NOT NULL filters into the shared
    subplan, so the two branches would no longer share one exchange.
    """
    counts = (_clean_text(counted).groupBy("primaryName", "decade")
              .agg(F.count(F.lit(1)).alias("film_per_decade"))
              .withColumnRenamed("primaryName", "_n").withColumnRenamed("decade", "_d"))
    out = _clean_text(rows.withColumnRenamed("nconst", "Nconst"))
    joined = out.join(counts, out["primaryName"].eqNullSafe(counts["_n"])
                      & out["decade"].eqNullSafe(counts["_d"]), "left")
    known = F.col("primaryName").isNotNull() & F.col("decade").isNotNull()
    return joined.withColumn("film_per_decade",
                             F.when(known, F.col("film_per_decade"))).select(*columns)


def actor_mart(credits: DataFrame) -> DataFrame:
    """Actor / actress credits with film count, rank per sex and films per
    decade of the same name (M7).

    ``nb_film`` counts a person's actor-or-actress credit rows; ``rank`` is
    the dense rank of ``nb_film`` (largest first) among rows of the same
    sex; ``film_per_decade`` counts rows with the same name and decade
    (homonyms add up; NULL name or decade gives NULL).

    Plan: counts and ranks are computed on one row per (person, sex), not
    per credit, and meet the credit rows in one join on the person id, in
    which the rows of a hot person are dealt to several tasks.
    """
    # credits never hold a NULL person id; stating it makes every branch
    # below start from the same filtered scan, so their exchanges are shared
    acting = credits.filter(F.col("category").rlike(ACTING) & F.col("nconst").isNotNull())
    per_person = dense_rank_desc(
        _credit_counts(acting, with_sexe=True).filter(F.col("sexe").isin(0, 1)),
        "nb_film", ["sexe"], counts=True).withColumn("rank", F.col("rank").cast("int"))
    base = (acting.filter(F.col("sexe").isin(0, 1) & F.col("sexe").isNotNull())
            .select("nconst", "tconst", "primaryName", "birthYear", "deathYear",
                    "primaryTitle", "originalTitle", "startYear", "runtimeMinutes",
                    "genres", "sexe", "age_in_movie", "age", "decade").distinct())
    rows = salted_join(base, per_person, ["nconst", "sexe"])
    return _finish_person_mart(rows, base, ACTOR_COLUMNS)


def director_mart(credits: DataFrame) -> DataFrame:
    """Director credits with film count, one global dense rank and films per
    decade of the same name (M8). Rows are not deduplicated: two director
    categories in one film give two equal rows."""
    directing = credits.filter(F.col("category").rlike(DIRECTING) & F.col("nconst").isNotNull())
    per_person = dense_rank_desc(_credit_counts(directing, with_sexe=False), "nb_film", [], counts=True)
    rows = salted_join(directing, per_person, ["nconst"]).select(
        "nconst", "tconst", "primaryName", "birthYear", "deathYear", "primaryProfession",
        "primaryTitle", "originalTitle", "startYear", "runtimeMinutes", "genres",
        "age_in_movie", "age", "decade", "nb_film", F.col("rank").cast("int").alias("rank"))
    return _finish_person_mart(rows, directing.select("primaryName", "decade"),
                               DIRECTOR_COLUMNS)
