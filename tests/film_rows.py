"""Hand-made film tables for the tests."""

from cinespark.plans.catalog import FilmTables

SENT = "\\N"

RAW_COLUMNS = {
    "title_basics": ["tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
                     "startYear", "runtimeMinutes", "genres"],
    "title_akas": ["titleId", "region"],
    "title_ratings": ["tconst", "averageRating", "numVotes"],
    "title_principals": ["tconst", "nconst", "category"],
    "name_basics": ["nconst", "primaryName", "birthYear", "deathYear", "primaryProfession"],
}


def film_tables(spark, **rows) -> FilmTables:
    """Typed film tables from hand-made raw rows (all text, '\\N' sentinel)."""
    raw = {}
    for name, cols in RAW_COLUMNS.items():
        data = rows.get(name, [])
        schema = ", ".join(f"{c} string" for c in cols)
        raw[name] = spark.createDataFrame(data, schema)
    return FilmTables.from_raw(raw)


def title(tconst, genres="Drama", year="1990", runtime="100", ttype="movie", adult="0",
          name=None):
    return (tconst, ttype, name or f"T {tconst}", name or f"T {tconst}", adult, year, runtime,
            genres)


def person(nconst, name=None, birth="1950", death=SENT, prof="actor"):
    return (nconst, name or f"P {nconst}", birth, death, prof)
