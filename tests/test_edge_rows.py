"""Hand-made edge rows (FIXTURES.md section 4): sentinel, multiplicity,
homonyms, ties, repairs."""

from pyspark.sql import functions as F

from film_rows import SENT, film_tables, person, title
from cinespark.plans import facets, features, marts
from cinespark.plans.pipeline import FilmPipeline
from cinespark.sources.serving import Serving


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_double_region_aka_counts_rows_not_titles(spark):
    t = film_tables(spark, title_basics=[title("tt1", "Drama,Comedy"), title("tt2", ttype="short")],
                    title_akas=[("tt1", "FR"), ("tt1", "FR"), ("tt2", "FR")],
                    title_ratings=[("tt1", "7.0", "100")])
    g = marts.stat_global(t).collect()
    assert [tuple(r) for r in g] == [(2, 3, 1, 2)]
    assert rows(marts.movie_genre(t), "tconst", "genre") == [("tt1", "Comedy"), ("tt1", "Drama")]


def test_no_region_aka_gives_empty_statistics(spark):
    t = film_tables(spark, title_basics=[title("tt1")], title_akas=[("tt1", "US")])
    assert marts.stat_global(t).count() == 0


def test_repeated_genre_and_sentinel_genre(spark):
    t = film_tables(spark,
                    title_basics=[title("tt1", "A,A"), title("tt2", SENT), title("tt3", "Adult,X")],
                    title_akas=[("tt1", "FR"), ("tt2", "FR"), ("tt3", "FR")],
                    title_ratings=[("tt1", "5.0", "10"), ("tt2", "6.0", "10"), ("tt3", "6.0", "1")])
    assert rows(marts.movie_genre(t), "tconst", "genre") == [("tt1", "A"), ("tt2", SENT), ("tt3", "X")]
    g = {r["genre"]: r for r in marts.genre_stats(t).collect()}
    assert set(g) == {"A", SENT, "Adult", "X"}  # Adult stays in the statistics
    assert g["A"]["averagerating"] == 5.0


def test_runtime_bounds(spark):
    t = film_tables(spark,
                    title_basics=[title("tt1", runtime="300"), title("tt2", runtime="301"),
                                  title("tt3", runtime=SENT)],
                    title_akas=[("tt1", "FR"), ("tt2", "FR"), ("tt3", "FR")],
                    title_ratings=[(f"tt{i}", "5.0", "1") for i in (1, 2, 3)])
    assert rows(marts.movie_genre(t), "tconst") == [("tt1",)]


def _credit_world(spark, principals, people, titles=None):
    titles = titles or [title("tt1", year="1995"), title("tt2", year="1996"),
                        title("tt3", year="1997")]
    return film_tables(spark, title_basics=titles,
                       title_akas=[(x[0], "FR") for x in titles],
                       title_ratings=[(x[0], "6.5", "10") for x in titles],
                       title_principals=principals, name_basics=people)


def test_person_in_two_categories_and_regex_categories(spark):
    t = _credit_world(spark,
                      principals=[("tt1", "nm1", "actor"), ("tt1", "nm1", "director"),
                                  ("tt2", "nm2", "casting_director"), ("tt2", "nm3", "writer")],
                      people=[person("nm1"), person("nm2"), person("nm3")])
    c = marts.credits_base(t, as_of_year=2023)
    assert rows(c, "nconst", "category") == [("nm1", "actor"), ("nm1", "director"),
                                             ("nm2", "casting_director")]
    cast = features.cast_distribution(c, actor_min=1, director_min=1, since=1970)
    assert {r["nb_film"] for r in cast.filter(F.col("primaryName") == "P nm1").collect()} == {2}
    d = marts.director_mart(c)
    assert rows(d, "Nconst") == [("nm1",), ("nm2",)]


def test_profession_sentinel_stays_null_profession_goes(spark):
    t = _credit_world(spark,
                      principals=[("tt1", "nm1", "actor"), ("tt1", "nm2", "actor"),
                                  ("tt1", "nm3", "actor")],
                      people=[person("nm1", prof=SENT), person("nm2", prof=None),
                              person("nm3", prof="cinematographer")])
    assert rows(marts.credits_base(t), "nconst") == [("nm1",)]


def test_ages_dead_alive_unknown(spark):
    t = _credit_world(spark,
                      principals=[("tt1", "nm1", "actor"), ("tt1", "nm2", "actor"),
                                  ("tt1", "nm3", "actor")],
                      people=[person("nm1", birth="1900", death="1980"),
                              person("nm2", birth="1950"),
                              person("nm3", birth=SENT)])
    got = {r["nconst"]: (r["age"], r["age_in_movie"], r["decade"])
           for r in marts.credits_base(t, as_of_year=2023).collect()}
    assert got == {"nm1": (80, 95, 1990), "nm2": (73, 45, 1990), "nm3": (None, None, 1990)}


def test_dense_rank_ties_and_homonyms(spark):
    t = _credit_world(spark,
                      principals=[("tt1", "nm1", "actor"), ("tt2", "nm1", "actor"),
                                  ("tt1", "nm2", "actor"), ("tt3", "nm2", "actor"),
                                  ("tt3", "nm3", "actor"), ("tt1", "nm4", "actress")],
                      people=[person("nm1", name="Same"), person("nm2", name="Same"),
                              person("nm3"), person("nm4")])
    a = marts.actor_mart(marts.credits_base(t))
    got = {(r["Nconst"], r["tconst"]): (r["nb_film"], r["rank"], r["film_per_decade"])
           for r in a.collect()}
    # nm1 and nm2 tie at 2 films -> rank 1; nm3 -> rank 2; nm4 ranks among actresses
    assert got[("nm1", "tt1")] == (2, 1, 4)  # homonyms: 4 rows named 'Same' in the 1990s
    assert got[("nm3", "tt3")] == (1, 2, 1)
    assert got[("nm4", "tt1")][:2] == (1, 1)


def test_unknown_year_gives_null_decade_and_leaves_ml(spark):
    t = _credit_world(spark,
                      principals=[("tt1", "nm1", "actor"), ("tt2", "nm1", "actor")],
                      people=[person("nm1")],
                      titles=[title("tt1", year=SENT), title("tt2", genres=SENT),
                              title("tt3", genres="Sci-Fi,Drama")])
    a = marts.actor_mart(marts.credits_base(t))
    r1 = [r for r in a.collect() if r["tconst"] == "tt1"][0]
    assert r1["decade"] is None and r1["film_per_decade"] is None
    p = FilmPipeline(t, actor_min=1, director_min=1)
    ml = p.ml_matrix(["drama", "sci_fi"])
    assert rows(ml, "tconst") == [("tt3",)]
    assert {"sci_fi", "drama"} <= set(ml.columns)


def test_cast_since_boundary(spark):
    t = _credit_world(spark,
                      principals=[("tt1", "nm1", "actor"), ("tt2", "nm1", "actor")],
                      people=[person("nm1")],
                      titles=[title("tt1", year="1970"), title("tt2", year="1971")])
    cast = features.cast_distribution(marts.credits_base(t), 1, 1, since=1970)
    assert rows(cast, "tconst", "nb_film") == [("tt2", 1)]


def _serving(spark, movies, actors=None, directors=None):
    mcols = "tconst string, primarytitle string, originaltitle string, startyear int, " \
            "decade int, runtimeminutes int, genres string, averagerating double, " \
            "numvotes bigint, genre string"
    pcols = "Nconst string, tconst string, primaryName string, sexe int, age int, " \
            "age_in_movie int, decade int, nb_film bigint, film_per_decade bigint, rank int"
    return Serving(movies=spark.createDataFrame(movies, mcols),
                   actors=spark.createDataFrame(actors or [], pcols),
                   directors=spark.createDataFrame(directors or [], pcols))


def _movie(tconst, genre="Drama", rating=6.9, decade=1990, votes=10):
    return (tconst, f"T {tconst}", f"T {tconst}", decade + 1, decade, 100, genre, rating,
            votes, genre)


def test_empty_selection_is_no_filter_and_note_filter_keeps_rating(spark):
    s = _serving(spark, [_movie("tt1", rating=6.9), _movie("tt2", rating=7.2)])
    assert facets.facet_filter(s, genres=[], decades=None, notes=[]).count() == 2
    kept = facets.facet_filter(s, notes=[6]).collect()
    assert [(r["tconst"], r["averagerating"]) for r in kept] == [("tt1", 6.9)]


def test_two_selected_actors_in_one_film_give_two_rows(spark):
    actor = lambda n, t, sex=0: (n, t, f"P {n}", sex, 50, 40, 1990, 12, 1, 1)
    s = _serving(spark, [_movie("tt1", "A"), _movie("tt1", "B")],
                 actors=[actor("nm1", "tt1"), actor("nm2", "tt1")])
    assert facets.facet_filter(s, actors=["nm1", "nm2"]).count() == 4
    k = facets.key_numbers(s, actors=["nm2", "nm1"]).collect()[0]
    assert (k["n_rows"], k["max_age"]) == (4, 50)
    names = facets.selected_names(s, actors=["nm2", "nm1"]).collect()
    assert [r["name"] for r in names] == ["P nm1", "P nm2"]


def test_top_performers_tie_at_cut_goes_by_name(spark):
    movies = [_movie(f"tt{i}") for i in range(40)]
    actors = [(f"nm{i:02d}", f"tt{i}", f"Name {i:02d}", i % 2, 50, 40, 1990, 12, 1, 1)
              for i in range(31)]
    actors.append(("nm00", "tt39", "Name 00", 0, 50, 40, 1990, 12, 1, 1))
    s = _serving(spark, movies, actors=actors)
    top = facets.top_performers(s, n=30).collect()
    assert len(top) == 30
    assert (top[0]["primaryName"], top[0]["n"], top[0]["sexe"]) == ("Name 00", 2, "Homme")
    assert top[-1]["primaryName"] == "Name 29"  # Name 30 loses the tie by name
