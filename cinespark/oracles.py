"""DuckDB oracle SQL, one text per query key.

Each text derives the film tables from the star-schema views the checker
registers (same derivation as ``sources/fixtures.py``), types them, and then
states the job in plain SQL: window counts over all rows, item positions
from a ``range``, scalar subqueries, conditional maxima. The Spark plans
compute the same results by other routes, so the two check each other.
"""

from __future__ import annotations

S = "chr(92) || 'N'"  # the two-character sentinel, written without escapes

FIXTURE_CTES = f"""
title_basics AS (
  SELECT concat('tt', lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(7, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0')) AS tconst,
         CASE p_type WHEN 'MEDIUM' THEN 'tvEpisode' WHEN 'PROMO' THEN 'short' WHEN 'STANDARD' THEN 'tvSeries' ELSE 'movie' END AS titleType,
         p_name AS primaryTitle, concat(p_brand, ' ', p_name) AS originalTitle,
         CASE WHEN p_partkey % 41 = 0 THEN '1' ELSE '0' END AS isAdult,
         CASE WHEN p_partkey % 29 = 0 THEN {S} ELSE CAST(1920 + (p_partkey * 7) % 100 AS VARCHAR) END AS startYear,
         CASE WHEN p_partkey % 23 = 0 THEN {S} ELSE CAST(p_size * 8 AS VARCHAR) END AS runtimeMinutes,
         CASE WHEN p_partkey % 31 = 0 THEN {S}
              WHEN p_partkey % 3 = 0 THEN split_part(p_name, ' ', 2)
              WHEN p_partkey % 3 = 1 THEN replace(p_name, ' ', ',')
              WHEN p_partkey % 47 = 0 THEN concat('Adult,', replace(p_name, ' ', ','))
              ELSE concat(replace(p_name, ' ', ','), ',', CASE WHEN p_size < 25 THEN 'News' ELSE 'Sci-Fi' END) END AS genres
  FROM part),
title_ratings AS (
  SELECT concat(CASE WHEN p_partkey % 5 = 0 THEN 'tx' ELSE 'tt' END, lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(7, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0')) AS tconst,
         CAST(CAST(10 + (p_partkey * 13) % 91 AS DOUBLE) / 10 AS VARCHAR) AS averageRating,
         CAST(5 + (p_partkey * 37) % 5000 AS VARCHAR) AS numVotes
  FROM part),
title_akas AS (
  SELECT concat('tt', lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(7, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0')) AS titleId,
         CASE r_name WHEN 'EUROPE' THEN 'FR' WHEN 'AMERICA' THEN 'US' WHEN 'ASIA' THEN 'JP' ELSE {S} END AS region
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey),
title_principals AS (
  SELECT concat('tt', lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(7, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0')) AS tconst,
         concat('nm', lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(7, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0')) AS nconst,
         CASE l_linenumber WHEN 1 THEN 'director' WHEN 2 THEN 'actor' WHEN 3 THEN 'actor' WHEN 4 THEN 'actress'
              WHEN 5 THEN 'actress' WHEN 6 THEN 'writer' ELSE 'producer' END AS category
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
name_basics AS (
  SELECT concat('nm', lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(7, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0')) AS nconst,
         concat('Person ', CAST(c_custkey // 2 AS VARCHAR)) AS primaryName,
         CASE WHEN c_custkey % 19 = 0 THEN {S} ELSE CAST(1880 + c_custkey % 110 AS VARCHAR) END AS birthYear,
         CASE WHEN c_custkey % 3 = 0 THEN CAST(1940 + c_custkey % 80 AS VARCHAR) ELSE {S} END AS deathYear,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'actor,miscellaneous' WHEN 'BUILDING' THEN 'cinematographer'
              WHEN 'MACHINERY' THEN {S} ELSE 'actor,director' END AS primaryProfession
  FROM customer),
tb AS (SELECT tconst, titleType, primaryTitle, originalTitle, TRY_CAST(isAdult AS INTEGER) AS isAdult,
              TRY_CAST(startYear AS INTEGER) AS startYear, TRY_CAST(runtimeMinutes AS INTEGER) AS runtimeMinutes,
              genres FROM title_basics),
ta AS (SELECT titleId, region FROM title_akas),
tr AS (SELECT tconst, TRY_CAST(averageRating AS DOUBLE) AS averageRating,
              TRY_CAST(numVotes AS BIGINT) AS numVotes FROM title_ratings),
tp AS (SELECT tconst, nconst, category FROM title_principals),
nb AS (SELECT nconst, primaryName, TRY_CAST(birthYear AS INTEGER) AS birthYear,
              TRY_CAST(deathYear AS INTEGER) AS deathYear, primaryProfession FROM name_basics)"""

AS_OF_YEAR = 2023


def _decade(c: str) -> str:
    return f"CAST(FLOOR({c} / 10) * 10 AS INTEGER)"


def _nn(c: str, alias: str | None = None) -> str:
    """Sentinel -> NULL."""
    return f"NULLIF({c}, {S}) AS {alias or c}"


CREDITS_CTE = f"""
credits AS (
  SELECT DISTINCT p.nconst, b.tconst, n.primaryName, n.birthYear, n.deathYear,
         b.primaryTitle, b.originalTitle, b.startYear, b.runtimeMinutes, b.genres, p.category,
         n.primaryProfession,
         CASE p.category WHEN 'actor' THEN 0 WHEN 'actress' THEN 1 END AS sexe,
         CASE WHEN n.deathYear > 0 THEN n.deathYear - n.birthYear
              ELSE {AS_OF_YEAR} - n.birthYear END AS age,
         b.startYear - n.birthYear AS age_in_movie,
         {_decade('b.startYear')} AS decade
  FROM tp AS p
  JOIN tb AS b ON b.tconst = p.tconst
  JOIN ta AS a ON a.titleId = b.tconst
  JOIN nb AS n ON n.nconst = p.nconst
  WHERE a.region = 'FR' AND b.titleType = 'movie' AND b.isAdult = 0
    AND regexp_matches(p.category, '(director|actor|actress)')
    AND NOT regexp_matches(n.primaryProfession, '(cinematographer|miscellaneous)'))"""

MOVIE_GENRE_CTE = f"""
fr_rated AS (
  SELECT DISTINCT b.tconst, b.primaryTitle, b.originalTitle, b.startYear, b.runtimeMinutes,
         b.genres, r.averageRating, r.numVotes, {_decade('b.startYear')} AS decade
  FROM tb AS b JOIN ta AS a ON a.titleId = b.tconst JOIN tr AS r ON r.tconst = b.tconst
  WHERE a.region = 'FR' AND b.titleType = 'movie' AND b.isAdult = 0 AND b.runtimeMinutes <= 300),
movie_genre AS (
  SELECT DISTINCT f.tconst, f.primaryTitle, f.originalTitle, f.startYear, f.decade,
         f.runtimeMinutes, f.genres, f.averageRating, f.numVotes,
         string_split(f.genres, ',')[pos.i] AS genre
  FROM fr_rated AS f, range(1, 4) AS pos(i)
  WHERE string_split(f.genres, ',')[pos.i] IS NOT NULL
    AND string_split(f.genres, ',')[pos.i] <> 'Adult')"""

MOVIE_MART_CTE = f"""
movie_mart AS (
  SELECT tconst, {_nn('primaryTitle', 'primarytitle')}, {_nn('originalTitle', 'originaltitle')},
         startYear AS startyear, decade, runtimeMinutes AS runtimeminutes, {_nn('genres')},
         averageRating AS averagerating, numVotes AS numvotes, {_nn('genre')}
  FROM movie_genre),
movie_filled AS (
  SELECT COALESCE(tconst, '-9999') AS tconst, COALESCE(primarytitle, '-9999') AS primarytitle,
         COALESCE(originaltitle, '-9999') AS originaltitle, COALESCE(startyear, -9999) AS startyear,
         COALESCE(decade, -9999) AS decade, COALESCE(runtimeminutes, -9999) AS runtimeminutes,
         COALESCE(genres, '-9999') AS genres, COALESCE(averagerating, -9999) AS averagerating,
         COALESCE(numvotes, -9999) AS numvotes, COALESCE(genre, '-9999') AS genre
  FROM movie_mart)"""

ACTOR_MART_CTE = f"""
acting AS (
  SELECT *, COUNT(*) OVER (PARTITION BY nconst) AS nb_film
  FROM credits WHERE regexp_matches(category, 'actor|actress')),
actor_ranked AS (
  SELECT DISTINCT nconst AS Nconst, tconst, {_nn('primaryName')}, birthYear, deathYear,
         {_nn('primaryTitle')}, {_nn('originalTitle')}, startYear, runtimeMinutes, {_nn('genres')},
         nb_film, sexe, age_in_movie, age, decade,
         CAST(DENSE_RANK() OVER (PARTITION BY sexe ORDER BY nb_film DESC) AS INTEGER) AS rank
  FROM acting WHERE sexe IN (0, 1)),
actor_mart AS (
  SELECT *, CASE WHEN primaryName IS NOT NULL AND decade IS NOT NULL
                 THEN COUNT(*) OVER (PARTITION BY primaryName, decade) END AS film_per_decade
  FROM actor_ranked)"""

DIRECTOR_MART_CTE = f"""
directing AS (
  SELECT nconst AS Nconst, tconst, {_nn('primaryName')}, birthYear, deathYear,
         {_nn('primaryProfession')}, {_nn('primaryTitle')}, {_nn('originalTitle')}, startYear,
         runtimeMinutes, {_nn('genres')}, age_in_movie, age, decade,
         COUNT(*) OVER (PARTITION BY nconst) AS nb_film
  FROM credits WHERE regexp_matches(category, 'director')),
director_mart AS (
  SELECT *, CAST(DENSE_RANK() OVER (ORDER BY nb_film DESC) AS INTEGER) AS rank,
         CASE WHEN primaryName IS NOT NULL AND decade IS NOT NULL
              THEN COUNT(*) OVER (PARTITION BY primaryName, decade) END AS film_per_decade
  FROM directing)"""


GENRE_STATS_CTE = """
genre_items AS (
  SELECT DISTINCT r.tconst, r.averageRating, r.numVotes,
         string_split(b.genres, ',')[pos.i] AS genre, b.runtimeMinutes
  FROM tb AS b JOIN tr AS r ON r.tconst = b.tconst, range(1, 4) AS pos(i)
  WHERE b.runtimeMinutes > 0),
genre_stats AS (
  SELECT genre, round(avg(runtimeMinutes), 2) AS runtimeminutes,
         round(avg(averageRating), 2) AS averagerating, round(avg(numVotes), 2) AS numvotes
  FROM genre_items WHERE genre IS NOT NULL GROUP BY genre)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join([FIXTURE_CTES, *ctes]) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["credits_base"] = with_ctes(CREDITS_CTE) + "SELECT * FROM credits"

ORACLES["movie_genre"] = with_ctes(MOVIE_GENRE_CTE) + "SELECT * FROM movie_genre ORDER BY tconst"

ORACLES["stat_global"] = with_ctes() + """
SELECT (SELECT COUNT(tconst) FROM tb) AS total_contenu,
       fr.n AS total_contenu_region,
       (SELECT COUNT(tconst) FROM tb WHERE titleType = 'movie') AS total_movie,
       (SELECT COUNT(b.tconst) FROM tb AS b JOIN ta AS a ON a.titleId = b.tconst
        WHERE b.titleType = 'movie' AND a.region = 'FR') AS total_movie_fr
FROM (SELECT region, COUNT(titleId) AS n FROM ta WHERE region = 'FR' GROUP BY region) AS fr"""

ORACLES["genre_stats"] = with_ctes(GENRE_STATS_CTE) + "SELECT * FROM genre_stats ORDER BY genre"

ORACLES["content_share"] = with_ctes() + """,
type_pairs AS (SELECT DISTINCT titleType, tconst FROM tb),
per_type AS (SELECT titleType, COUNT(tconst) AS n FROM type_pairs GROUP BY titleType)
SELECT titleType, round(n / (SELECT SUM(n) FROM per_type) * 100, 6) AS percent
FROM per_type ORDER BY percent DESC"""

ORACLES["movie_mart"] = with_ctes(MOVIE_GENRE_CTE, MOVIE_MART_CTE) + "SELECT * FROM movie_filled"

ORACLES["actor_mart"] = with_ctes(CREDITS_CTE, ACTOR_MART_CTE) + "SELECT * FROM actor_mart"

ORACLES["director_mart"] = with_ctes(CREDITS_CTE, DIRECTOR_MART_CTE) + "SELECT * FROM director_mart"


# ------------------------------------------------------------------ M9-M11

ACTOR_MIN_FIXTURE = 5
DIRECTOR_MIN_FIXTURE = 3

CAST_CTE = f"""
recent AS (
  SELECT tconst, primaryName, category, COUNT(*) OVER (PARTITION BY nconst) AS nb_film
  FROM credits WHERE startYear > 1970),
cast_distribution AS (
  SELECT tconst, primaryName, nb_film FROM recent
  WHERE (regexp_matches(category, '(actor|actress)') AND nb_film >= {ACTOR_MIN_FIXTURE})
     OR (regexp_matches(category, 'director') AND nb_film >= {DIRECTOR_MIN_FIXTURE})),
movie_cast AS (
  SELECT m.tconst, c.primaryName, m.primaryTitle, m.originalTitle, m.genres, m.startYear,
         m.decade, m.runtimeMinutes, m.averageRating, m.numVotes, m.genre
  FROM movie_genre AS m LEFT JOIN cast_distribution AS c ON c.tconst = m.tconst)"""

ML_KEYS_SQL = ("tconst, primarytitle, originaltitle, genres, startyear, decade, runtimeminutes, "
               "averagerating, numvotes")


def _fname(c: str) -> str:
    return f"replace(replace(replace(lower({c}), '_', ''), '-', '_'), ' ', '_')"


ML_ROWS_CTE = f"""
ml_rows AS (
  SELECT NULLIF(tconst, {S}) AS tconst, NULLIF(primaryTitle, {S}) AS primarytitle,
         NULLIF(originalTitle, {S}) AS originaltitle, NULLIF(genres, {S}) AS genres,
         startYear AS startyear, decade, runtimeMinutes AS runtimeminutes,
         averageRating AS averagerating, numVotes AS numvotes,
         NULLIF(genre, {S}) AS genre, NULLIF(primaryName, {S}) AS primaryname
  FROM movie_cast),
ml_films AS (
  SELECT DISTINCT {ML_KEYS_SQL} FROM ml_rows
  WHERE tconst IS NOT NULL AND primarytitle IS NOT NULL AND originaltitle IS NOT NULL
    AND genres IS NOT NULL AND startyear IS NOT NULL AND decade IS NOT NULL
    AND runtimeminutes IS NOT NULL AND averagerating IS NOT NULL AND numvotes IS NOT NULL)"""


ML_BASE = with_ctes(CREDITS_CTE, MOVIE_GENRE_CTE, CAST_CTE, ML_ROWS_CTE)


def _ml_pairs(kinds: list[str]) -> str:
    """Distinct (film keys, kind, feature) of films with every key known."""
    source = {"genre": "genre", "name": "primaryname"}
    pairs = " UNION ALL ".join(
        f"SELECT {ML_KEYS_SQL}, '{k}' AS kind, {_fname(source[k])} AS feature FROM ml_rows" for k in kinds)
    return f"SELECT DISTINCT f.*, x.kind, x.feature FROM ml_films AS f JOIN ({pairs}) AS x USING ({ML_KEYS_SQL}) WHERE x.feature IS NOT NULL"


def _ml_long(kinds: list[str]) -> str:
    return ML_BASE + (f"SELECT * FROM ({_ml_pairs(kinds)}) UNION ALL "
                      f"SELECT *, NULL AS kind, NULL AS feature FROM (SELECT * FROM ml_films "
                      f"EXCEPT SELECT {ML_KEYS_SQL} FROM ({_ml_pairs(kinds)}))")


#: Columns of the people: their features in code point order, numbered from 0.
ML_NAMES = f"""
ml_names AS (
  SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx
  FROM (SELECT DISTINCT {_fname("primaryname")} AS feature FROM ml_rows WHERE primaryname IS NOT NULL))"""


def _ml_vectors() -> str:
    """The columns of each film's people in ascending order, and a 1 for each."""
    lists = (f"SELECT {ML_KEYS_SQL}, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices, "
             f"string_agg('1', ',') AS \"values\" FROM ({_ml_pairs(['name'])}) JOIN ml_names USING (feature) GROUP BY {ML_KEYS_SQL}")
    return (ML_BASE + f", {ML_NAMES} SELECT f.*, coalesce(v.indices, '') AS indices, coalesce(v.\"values\", '') AS \"values\" "
            f"FROM ml_films AS f LEFT JOIN ({lists}) AS v USING ({ML_KEYS_SQL})")


def _ml_wide(names: bool) -> str:
    """One column per genre of the list, and the columns of the people as one text."""
    from cinespark.fixture_params import GENRE_VOCABULARY
    cols = ", ".join(f"coalesce(max(CASE WHEN kind = 'genre' AND feature = '{g}' THEN 1 ELSE 0 END), 0) AS \"{g}\"" for g in GENRE_VOCABULARY)
    if names:
        cols += ", coalesce(string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) FILTER (WHERE kind = 'name'), '') AS name_indices"
    return ML_BASE + (f", {ML_NAMES} SELECT {ML_KEYS_SQL}, {cols} FROM ml_films LEFT JOIN ({_ml_pairs(['genre', 'name'])}) "
                      f"USING ({ML_KEYS_SQL}) LEFT JOIN ml_names USING (feature) GROUP BY {ML_KEYS_SQL}")


ORACLES["cast_distribution"] = (with_ctes(CREDITS_CTE, MOVIE_GENRE_CTE, CAST_CTE)
                                + "SELECT * FROM cast_distribution")
ORACLES["movie_cast"] = (with_ctes(CREDITS_CTE, MOVIE_GENRE_CTE, CAST_CTE)
                         + "SELECT * FROM movie_cast")
ORACLES["ml_genre_onehot"] = _ml_wide(names=False)
ORACLES["ml_cast_onehot"] = _ml_vectors()
ORACLES["ml_cast_vocabulary"] = ML_BASE + f", {ML_NAMES} SELECT feature, idx FROM ml_names"
ORACLES["ml_matrix"] = _ml_wide(names=True)
ORACLES["ml_matrix_long"] = _ml_long(["genre", "name"])


# ------------------------------------------------------------------ serving + D1-D9

from cinespark import fixture_params as P  # noqa: E402

_ACTOR_KINDS = [("Nconst", "s"), ("tconst", "s"), ("primaryName", "s"), ("birthYear", "n"),
                ("deathYear", "n"), ("primaryTitle", "s"), ("originalTitle", "s"),
                ("startYear", "n"), ("runtimeMinutes", "n"), ("genres", "s"), ("nb_film", "n"),
                ("sexe", "n"), ("age_in_movie", "n"), ("age", "n"), ("decade", "n"),
                ("rank", "n"), ("film_per_decade", "n")]
_DIRECTOR_KINDS = [("Nconst", "s"), ("tconst", "s"), ("primaryName", "s"), ("birthYear", "n"),
                   ("deathYear", "n"), ("primaryProfession", "s"), ("primaryTitle", "s"),
                   ("originalTitle", "s"), ("startYear", "n"), ("runtimeMinutes", "n"),
                   ("genres", "s"), ("age_in_movie", "n"), ("age", "n"), ("decade", "n"),
                   ("nb_film", "n"), ("rank", "n"), ("film_per_decade", "n")]


def _fill(kinds) -> str:
    return ", ".join(f"COALESCE({c}, '-9999') AS {c}" if k == "s" else f"COALESCE({c}, -9999) AS {c}"
                     for c, k in kinds)


SERVING_CTE = f"""
movie_serving AS (
  SELECT * FROM movie_filled
  WHERE decade > 0 AND genre <> '-9999' AND runtimeminutes > 0 AND averagerating > 0),
actor_serving AS (
  SELECT * FROM (SELECT {_fill(_ACTOR_KINDS)} FROM actor_mart)
  WHERE nb_film > {P.ACTOR_SERVING_MIN} AND age > 0 AND age_in_movie > 0),
director_serving AS (
  SELECT * FROM (SELECT {_fill(_DIRECTOR_KINDS)} FROM director_mart)
  WHERE nb_film > {P.DIRECTOR_SERVING_MIN} AND age > 0),
sel_a AS (SELECT DISTINCT Nconst FROM actor_serving WHERE rank <= {P.SELECT_RANK}),
sel_d AS (SELECT DISTINCT Nconst FROM director_serving WHERE rank <= {P.SELECT_RANK})"""

SERVING_BASE = with_ctes(CREDITS_CTE, MOVIE_GENRE_CTE, MOVIE_MART_CTE, ACTOR_MART_CTE,
                         DIRECTOR_MART_CTE, SERVING_CTE)


def _lit_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def facet_films(genres=None, decades=None, notes=None, actors=False, directors=False) -> str:
    """SQL of D1 for the given facets; ``actors`` / ``directors`` select
    the rank-based people."""
    conds = []
    if genres:
        conds.append(f"genre IN ({_lit_list(genres)})")
    if decades:
        conds.append(f"decade IN ({_lit_list(decades)})")
    if notes:
        conds.append(f"CAST(FLOOR(averagerating) AS INTEGER) IN ({_lit_list(notes)})")
    base = "SELECT * FROM movie_serving" + (" WHERE " + " AND ".join(conds) if conds else "")
    a = "(SELECT * FROM actor_serving WHERE Nconst IN (SELECT Nconst FROM sel_a))"
    d = "(SELECT * FROM director_serving WHERE Nconst IN (SELECT Nconst FROM sel_d))"
    if actors and directors:
        return (f"SELECT f.*, a.primaryName AS primaryName_x, a.Nconst AS Nconst_x, a.sexe, "
                f"a.age AS age_x, d.primaryName AS primaryName_y, d.Nconst AS Nconst_y, "
                f"d.age AS age_y FROM ({base}) f JOIN {a} a ON f.tconst = a.tconst "
                f"JOIN {d} d ON f.tconst = d.tconst")
    if actors:
        return (f"SELECT f.*, a.primaryName, a.Nconst, a.age, a.sexe FROM ({base}) f "
                f"JOIN {a} a ON f.tconst = a.tconst")
    if directors:
        return (f"SELECT f.*, d.primaryName, d.Nconst, d.age FROM ({base}) f "
                f"JOIN {d} d ON f.tconst = d.tconst")
    return base


def key_numbers_sql(actors=False, directors=False, **facets) -> str:
    if actors and directors:
        age = "greatest(max(age_x), max(age_y))"
    elif actors or directors:
        age = "max(age)"
    else:
        age = "CAST(NULL AS INTEGER)"
    return (SERVING_BASE + f"SELECT COUNT(*) AS n_rows, format('{{:,}}', COUNT(*)) AS n_rows_label, "
            f"round(avg(averagerating), 2) AS mean_rating, "
            f"CAST(round_even(avg(runtimeminutes), 0) AS INTEGER) AS mean_runtime, "
            f"CAST({age} AS INTEGER) AS max_age "
            f"FROM ({facet_films(actors=actors, directors=directors, **facets)})")


def grouped_sql(by: list[str], cols: list[str], films: str) -> str:
    keys = ", ".join(by)
    aggs = ", ".join(f"round(avg({c}), 4) AS {c}" for c in cols)
    return SERVING_BASE + f"SELECT {keys}, {aggs} FROM ({films}) GROUP BY {keys} ORDER BY {keys}"


def age_by_sex_sql(by: list[str], genres=None, decades=None, notes=None) -> str:
    films = facet_films(genres, decades, notes)
    extra = f" AND a.decade IN ({_lit_list(decades)})" if decades else ""
    rows = (f"SELECT f.tconst, f.genre, f.decade, a.sexe, a.age_in_movie FROM ({films}) f "
            f"JOIN actor_serving a ON f.tconst = a.tconst WHERE f.genre <> 'News'{extra}")
    return grouped_sql(by, ["age_in_movie"], rows)


def top_performers_sql(n: int = 30, directors=False, **facets) -> str:
    films = facet_films(directors=directors, **facets)
    return (SERVING_BASE + f"SELECT primaryName, CASE WHEN sexe = 0 THEN 'Homme' ELSE 'Femme' END AS sexe, n "
            f"FROM (SELECT a.primaryName, a.sexe, COUNT(f.tconst) AS n FROM ({films}) f "
            f"JOIN actor_serving a ON f.tconst = a.tconst GROUP BY a.primaryName, a.sexe "
            f"ORDER BY n DESC, primaryName ASC, sexe ASC LIMIT {n})")


def movie_table_sql(page: int = 0, size: int = 25, **facets) -> str:
    return (SERVING_BASE + f"SELECT tconst, primarytitle, startyear, decade, runtimeminutes, genres, "
            f"averagerating, numvotes FROM ({facet_films(**facets)}) "
            f"ORDER BY decade DESC, numvotes DESC, averagerating DESC, tconst ASC, genre ASC "
            f"LIMIT {size} OFFSET {page * size}")


G, D, N = P.GENRES, P.DECADES, P.NOTES

ORACLES["serving_scan_movie"] = SERVING_BASE + "SELECT * FROM movie_serving"
ORACLES["serving_scan_actor"] = SERVING_BASE + "SELECT * FROM actor_serving"
ORACLES["serving_scan_director"] = SERVING_BASE + "SELECT * FROM director_serving"

ORACLES["facet_filter"] = SERVING_BASE + facet_films(G, D, N)
ORACLES["facet_filter_actors"] = SERVING_BASE + facet_films(actors=True)
ORACLES["facet_filter_directors"] = SERVING_BASE + facet_films(directors=True)
ORACLES["facet_filter_both"] = SERVING_BASE + facet_films(actors=True, directors=True)
ORACLES["facet_filter_empty"] = SERVING_BASE + facet_films()

ORACLES["facet_filter_third"] = SERVING_BASE + (
    f"SELECT f.*, a.primaryName, a.Nconst, a.age, a.sexe FROM ({facet_films(G)}) f "
    f"JOIN actor_serving a ON f.tconst = a.tconst WHERE CAST(substr(a.Nconst, 3) AS BIGINT) % 3 = 0")
ORACLES["facet_cube"] = SERVING_BASE + """
SELECT genre, decade, note, CAST(grouping(genre, decade, note) AS INTEGER) AS level, COUNT(*) AS n,
       CAST(sum(CAST(averagerating AS DECIMAL(28, 10))) AS DOUBLE) AS averagerating,
       CAST(sum(numvotes) AS BIGINT) AS numvotes, CAST(sum(runtimeminutes) AS BIGINT) AS runtimeminutes
FROM (SELECT *, CAST(floor(averagerating) AS INTEGER) AS note FROM movie_serving)
GROUP BY GROUPING SETS ((), (genre), (decade), (genre, note), (decade, note), (genre, decade), (genre, decade, note))"""

ORACLES["key_numbers"] = key_numbers_sql()
ORACLES["key_numbers_actors"] = key_numbers_sql(actors=True)
ORACLES["key_numbers_directors"] = key_numbers_sql(directors=True)
ORACLES["key_numbers_both"] = key_numbers_sql(actors=True, directors=True)

ORACLES["selected_names"] = SERVING_BASE + """
SELECT 'actor' AS kind, Nconst, max(primaryName) AS name FROM actor_serving
WHERE Nconst IN (SELECT Nconst FROM sel_a) GROUP BY Nconst
UNION ALL SELECT 'director', Nconst, max(primaryName) FROM director_serving
WHERE Nconst IN (SELECT Nconst FROM sel_d) GROUP BY Nconst"""

ORACLES["count_by_genre"] = (SERVING_BASE + f"SELECT genre, COUNT(*) AS n FROM ({facet_films(G, None, N)}) "
                             f"GROUP BY genre ORDER BY genre")
ORACLES["count_by_decade"] = (SERVING_BASE + f"SELECT decade, COUNT(*) AS n FROM ({facet_films(None, D, N)}) "
                              f"GROUP BY decade ORDER BY decade")

_RV = ["averagerating", "numvotes"]
ORACLES["rating_votes_by_genre"] = grouped_sql(["genre"], _RV, facet_films(G, None, N))
ORACLES["rating_votes_by_decade"] = grouped_sql(["decade"], _RV, facet_films(G, None, N))
ORACLES["rating_votes_by_decade_genre"] = grouped_sql(["decade", "genre"], _RV, facet_films(G, D, N))

ORACLES["runtime_by_genre"] = grouped_sql(["genre"], ["runtimeminutes"], facet_films(G, None, N))
ORACLES["runtime_by_decade"] = grouped_sql(["decade"], ["runtimeminutes"], facet_films(G, D, N))
ORACLES["runtime_by_decade_genre"] = grouped_sql(["decade", "genre"], ["runtimeminutes"],
                                                 facet_films(G, D, N))

ORACLES["age_by_sex_genre"] = age_by_sex_sql(["sexe", "genre"], G, None, N)
ORACLES["age_by_sex_decade"] = age_by_sex_sql(["sexe", "decade"], G, None, N)
ORACLES["age_by_sex_decade_genre"] = age_by_sex_sql(["sexe", "decade", "genre"], G, D, N)

ORACLES["top_performers"] = top_performers_sql(30)
ORACLES["top_performers_filtered"] = top_performers_sql(30, directors=True, genres=G, notes=N)

ORACLES["movie_table"] = movie_table_sql(0, 25, genres=G, notes=N)
ORACLES["movie_table_page1"] = movie_table_sql(1, 25, genres=G, notes=N)
ORACLES["movie_table_deep"] = movie_table_sql(P.DEEP_PAGE, 25)
ORACLES["movie_table_deep_filtered"] = movie_table_sql(P.DEEP_PAGE_FILTERED, 25, genres=G, notes=N)

ORACLES["facet_options"] = SERVING_BASE + """
SELECT 'genre' AS facet, genre AS value, genre AS label FROM (SELECT DISTINCT genre FROM movie_serving)
UNION ALL SELECT 'note', CAST(i AS VARCHAR), CAST(i AS VARCHAR) FROM range(1, 11) t(i)
UNION ALL SELECT 'actor', Nconst, max(primaryName) FROM actor_serving GROUP BY Nconst
UNION ALL SELECT 'director', Nconst, max(primaryName) FROM director_serving GROUP BY Nconst
UNION ALL SELECT 'decade', CAST(decade AS VARCHAR), CAST(decade AS VARCHAR)
          FROM (SELECT DISTINCT decade FROM movie_serving)
UNION ALL SELECT 'see_value', v, v FROM (VALUES ('decade'), ('genre')) t(v)"""


# ------------------------------------------------------------------ S1, S2, S4, S5

for _key, _cte in (("read_tables", "tb"), ("read_title_akas", "ta"), ("read_title_ratings", "tr"),
                   ("read_title_principals", "tp"), ("read_name_basics", "nb")):
    ORACLES[_key] = with_ctes() + f"SELECT * FROM {_cte}"

_TITLE_LINE = "concat_ws(chr(9), tconst, titleType, primaryTitle, originalTitle, isAdult, startYear{})"
ORACLES["read_bad_rows"] = with_ctes() + """
SELECT tconst, titleType, primaryTitle, originalTitle, isAdult, startYear,
       CASE WHEN CAST(substr(tconst, 3) AS BIGINT) % 50 <> 0 THEN runtimeMinutes END AS runtimeMinutes,
       CASE WHEN CAST(substr(tconst, 3) AS BIGINT) % 50 <> 0 THEN genres END AS genres FROM tb"""

ORACLES["read_rejects"] = with_ctes() + f"""
SELECT 6 AS n_cells, {_TITLE_LINE.format("")} AS record FROM title_basics WHERE CAST(substr(tconst, 3) AS BIGINT) % 50 = 0
UNION ALL SELECT 10, {_TITLE_LINE.format(", runtimeMinutes, genres, 'more', 'cells'")} FROM title_basics
WHERE CAST(substr(tconst, 3) AS BIGINT) % 50 <> 0 AND CAST(substr(tconst, 3) AS BIGINT) % 77 = 0"""

ORACLES["person_last_names"] = with_ctes() + """
SELECT nconst, CASE WHEN CAST(substr(nconst, 3) AS BIGINT) % 7 = 0 THEN 'A ' || primaryName ELSE primaryName END AS primaryName
FROM nb"""

ORACLES["source_check"] = with_ctes() + """
SELECT 'name_basics' AS table_name, true AS present, COUNT(*) AS n_rows FROM name_basics
UNION ALL SELECT 'title_akas', true, COUNT(*) FROM title_akas
UNION ALL SELECT 'title_basics', true, COUNT(*) FROM title_basics
UNION ALL SELECT 'title_principals', true, COUNT(*) FROM title_principals
UNION ALL SELECT 'title_ratings', true, COUNT(*) FROM title_ratings"""

ORACLES["csv_sink_titles"] = with_ctes() + """
SELECT tconst, ' ' || coalesce(primaryTitle, '') || '"x", y;' AS title FROM tb"""

ORACLES["csv_sink_index"] = with_ctes(MOVIE_GENRE_CTE, MOVIE_MART_CTE) + """
SELECT CAST(row_number() OVER (ORDER BY tconst, genre NULLS LAST, startyear NULLS LAST) - 1 AS VARCHAR) AS index,
       tconst, coalesce(genre, '-9999') AS genre, CAST(coalesce(startyear, -9999) AS VARCHAR) AS startyear
FROM movie_mart"""

ORACLES["csv_sink"] = with_ctes(GENRE_STATS_CTE) + """
SELECT genre, replace(CAST(runtimeminutes AS VARCHAR), '.', ',') AS runtimeminutes,
       replace(CAST(averagerating AS VARCHAR), '.', ',') AS averagerating,
       replace(CAST(numvotes AS VARCHAR), '.', ',') AS numvotes
FROM genre_stats"""

_MOVIE_KINDS = [("tconst", "s"), ("primarytitle", "s"), ("originaltitle", "s"), ("startyear", "n"), ("decade", "n"),
                ("runtimeminutes", "n"), ("genres", "s"), ("averagerating", "n"), ("numvotes", "n"), ("genre", "s")]


def _as_double(kinds) -> str:
    return ", ".join(c if k == "s" else f"CAST({c} AS DOUBLE) AS {c}" for c, k in kinds)


for _key, _ctes, _mart, _kinds in (
        ("movie", [MOVIE_GENRE_CTE, MOVIE_MART_CTE], "movie_mart", _MOVIE_KINDS),
        ("actor", [CREDITS_CTE, ACTOR_MART_CTE], "actor_mart", _ACTOR_KINDS),
        ("director", [CREDITS_CTE, DIRECTOR_MART_CTE], "director_mart", _DIRECTOR_KINDS)):
    ORACLES[f"decimal_cast_{_key}"] = with_ctes(*_ctes) + f"SELECT {_as_double(_kinds)} FROM (SELECT {_fill(_kinds)} FROM {_mart})"

ORACLES["decimal_comma_cast"] = with_ctes(GENRE_STATS_CTE) + "SELECT * FROM genre_stats"
