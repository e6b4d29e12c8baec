"""Invariants of the reference's committed outputs, I/O round trips, and
brute-force checks of the wide one-hot against pandas."""

import pytest
from pyspark.sql import functions as F

from film_rows import RAW_COLUMNS, SENT, film_tables, person, title
from cinespark import fixture_params as P
from cinespark.functions.columns import feature_name_py
from cinespark.plans import facets, features, marts
from cinespark.plans.catalog import load_film_tables
from cinespark.plans.pipeline import FilmPipeline
from cinespark.session import scratch_path
from cinespark.sources import check, sinks, tsv

SF = "/root/testdata/sf0.01"


def test_content_shares_add_to_100_descending(spark):
    rows = marts.content_share(load_film_tables(spark, SF)).collect()
    pct = [r["percent"] for r in rows]
    assert abs(sum(pct) - 100.0) < 1e-9
    assert pct == sorted(pct, reverse=True)


def test_stat_global_bounds(spark):
    r = marts.stat_global(load_film_tables(spark, SF)).collect()[0]
    assert r["total_movie"] <= r["total_contenu"]
    assert r["total_movie_fr"] <= r["total_contenu_region"]


def test_genre_stats_shape(spark):
    rows = marts.genre_stats(load_film_tables(spark, SF)).collect()
    genres = [r["genre"] for r in rows]
    assert None not in genres and SENT in genres
    assert genres == sorted(genres)
    for r in rows:
        for c in ("runtimeminutes", "averagerating", "numvotes"):
            assert round(r[c], 2) == r[c]


def test_tsv_round_trip_keeps_sentinel_and_quotes(spark):
    raw = spark.createDataFrame(
        [("tt1", "movie", '"Quoted" start', "a,b", "0", SENT, "90", SENT),
         ("tt2", "short", "plain", "x", "1", "1999", SENT, "Drama,News")],
        ", ".join(f"{c} string" for c in ["tconst", "titleType", "primaryTitle",
                                           "originalTitle", "isAdult", "startYear",
                                           "runtimeMinutes", "genres"]))
    folder = scratch_path(spark, "tsv-test")
    tsv.write_raw_tsv(raw, f"{folder}/title.basics.tsv.gz")
    t = tsv.read_tables(spark, folder, names=["title.basics"], register=True)
    got = {r["tconst"]: r for r in spark.table("title_basics").collect()}
    assert got["tt1"]["primaryTitle"] == '"Quoted" start'
    assert got["tt1"]["startYear"] is None and got["tt1"]["genres"] == SENT
    assert got["tt2"]["runtimeMinutes"] is None and got["tt2"]["startYear"] == 1999
    assert dict(t.title_basics.dtypes)["isAdult"] == "int"


def test_source_check_reports_missing_file(spark):
    folder = scratch_path(spark, "tsv-check")
    raw = spark.createDataFrame([("tt1", "FR")], "titleId string, region string")
    tsv.write_raw_tsv(raw, f"{folder}/title.akas.tsv.gz")
    got = {r["table_name"]: (r["present"], r["n_rows"])
           for r in check.source_check_path(spark, folder).collect()}
    assert got["title_akas"] == (True, 1)
    assert got["title_basics"] == (False, None)
    assert len(got) == 5


def test_csv_sink_decimal_comma_and_fill(spark):
    df = spark.createDataFrame([("a", 6.92, None), ("b", None, 3)],
                               "genre string, rating double, n int")
    path = scratch_path(spark, "csv-test")
    sinks.csv_sink(df, path, single_file=True)
    text = {r["genre"]: r for r in sinks.read_csv_text(spark, path).collect()}
    assert text["a"]["rating"] == "6,92" and text["a"]["n"] == "-9999"
    assert text["b"]["rating"] == "-9999,0"
    back = sinks.decimal_comma_cast(sinks.read_csv_text(spark, path), ["rating"])
    assert {r["genre"]: r["rating"] for r in back.collect()} == {"a": 6.92, "b": -9999.0}


def test_parquet_sink_range_order(spark):
    df = spark.range(1000).select(F.format_string("tt%04d", (F.lit(999) - F.col("id"))).alias("tconst"))
    path = scratch_path(spark, "pq-test")
    sinks.parquet_sink(df, path, range_key="tconst", partitions=4)
    got = [r[0] for r in spark.read.parquet(path).collect()]
    assert sorted(got) == sorted(r[0] for r in df.collect())


def test_ml_matrix_keeps_genres_and_names_apart(spark):
    """Brute force on a small fixture, with an actor named like a genre."""
    t = film_tables(
        spark,
        title_basics=[title("tt1", "Sci-Fi,Drama"), title("tt2", "Drama"),
                      title("tt3", "Film-Noir", year=SENT), title("tt4", "News,Drama")],
        title_akas=[(f"tt{i}", "FR") for i in range(1, 5)],
        title_ratings=[(f"tt{i}", "6.5", "10") for i in range(1, 5)],
        title_principals=[("tt1", "nm1", "actor"), ("tt2", "nm1", "actor"),
                          ("tt1", "nm2", "director"), ("tt4", "nm3", "actress"), ("tt2", "nm4", "director")],
        name_basics=[person("nm1", name="Jean-Luc Big"), person("nm2", name="Ann_Lee"),
                     person("nm3", name="Zoe"), person("nm4", name="News")])
    p = FilmPipeline(t, actor_min=2, director_min=1)
    genres = ["drama", "news", "sci_fi", "western"]
    got = {r["tconst"]: r for r in p.ml_matrix(genres).collect()}
    mc = p.movie_cast.toPandas()
    names = {r["idx"]: r["feature"] for r in p.name_vocabulary.collect()}
    assert [names[i] for i in range(len(names))] == sorted({feature_name_py(x) for x in mc["primaryName"].dropna()})
    assert set(got) == {"tt1", "tt2", "tt4"}
    for k, r in got.items():
        rows = mc[mc["tconst"] == k]
        assert [r[g] for g in genres] == [int(g in {feature_name_py(x) for x in rows["genre"]}) for g in genres]
        assert [names[i] for i in r["name_indices"]] == sorted({feature_name_py(x) for x in rows["primaryName"].dropna()})
    assert got["tt2"]["news"] == 0 and "news" in [names[i] for i in got["tt2"]["name_indices"]]
    vectors = {r["tconst"]: r for r in features.ml_sparse(p.movie_cast, p.name_vocabulary).collect()}
    assert {k: r["name_indices"] for k, r in got.items()} == {k: r["indices"] for k, r in vectors.items()}
    assert all(r["values"] == [1] * len(r["indices"]) for r in vectors.values())
    with pytest.raises(Exception, match="vocabulary"):
        p.ml_matrix(["drama"]).collect()
    long = {(r["tconst"], r["kind"], r["feature"]) for r in features.ml_onehot_long(p.movie_cast).collect()}
    assert ("tt2", "name", "news") in long and ("tt2", "genre", "news") not in long
    assert {(k, g) for k, kind, g in long if kind == "genre"} == {(k, g) for k, r in got.items() for g in genres if r[g]}


def test_csv_of_titles_is_plain_csv(spark):
    """Quotes, commas, semicolons and blanks, read by Python's csv module."""
    import csv
    import glob
    rows = [("tt1", '  say "hi", x; y '), ("tt2", '"'), ("tt3", "a\\b"), ("tt4", "plain")]
    df = spark.createDataFrame(rows, "tconst string, title string")
    for sep in (",", ";"):
        path = scratch_path(spark, "csv-titles")
        sinks.csv_sink(df, path, sep=sep, single_file=True)
        with open(glob.glob(f"{path}/part-*.csv")[0], newline="", encoding="utf-8") as f:
            assert sorted(map(tuple, list(csv.reader(f, delimiter=sep))[1:])) == rows
        assert sorted(map(tuple, sinks.read_csv_text(spark, path, sep).collect())) == rows


def test_bad_tsv_rows_are_reported(spark, tmp_path):
    (tmp_path / "title.akas.tsv").write_text("titleId\tregion\ntt1\tFR\textra\n")
    with pytest.raises(Exception):
        tsv.read_raw_tsv(spark, str(tmp_path / "title.akas.tsv")).collect()
    (tmp_path / "t.tsv").write_text("titleId\tregion\n  tt1 \t FR\n")
    assert [tuple(r) for r in tsv.read_raw_tsv(spark, str(tmp_path / "t.tsv")).collect()] == [("  tt1 ", " FR")]


def test_bad_rows_are_kept_and_listed_with_their_place(spark, tmp_path):
    """Short rows are padded, long ones cut; the list gives file, byte and text (umlauts and an empty line in between)."""
    files = {"a.tsv": "x\ty\tz\n1\tä\t3\n4\t5\n\n6\t7\t8\t9\n", "b.tsv": "x\ty\tz\nü\tü\tü\n1\n2\t\t\n"}
    (tmp_path / "in").mkdir()
    for name, text in files.items():
        (tmp_path / "in" / name).write_bytes(text.encode())
    path = str(tmp_path / "in")
    got = sorted(map(tuple, tsv.read_raw_tsv(spark, path, keep_bad_rows=True).collect()), key=repr)
    assert got == sorted([("1", "ä", "3"), ("4", "5", None), ("6", "7", "8"), ("ü", "ü", "ü"), ("1", None, None), ("2", None, None)], key=repr)
    bad = tsv.tsv_rejects(spark, path).collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["n_cells"], r["record"]) for r in bad) == [
        ("a.tsv", 2, "4\t5"), ("a.tsv", 4, "6\t7\t8\t9"), ("b.tsv", 1, "1")]
    for r in bad:
        at = files[r["file"].rsplit("/", 1)[1]].encode()[r["offset"]:]
        assert at.split(b"\n")[0].decode() == r["record"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8")          # blocks within a file
    try:
        again = tsv.tsv_rejects(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(map(tuple, again)) == sorted(map(tuple, bad))


def test_last_source_row_names_a_person(spark):
    """Two rows of one person: the later one's name is the option, whatever their alphabetical order."""
    folder = scratch_path(spark, "last-names")
    people = [person("nm1", name="Zed"), person("nm2", name="Amy"), person("nm1", name="Bob"), person("nm2", name="Amy")]
    world = {"title.basics": ("title_basics", [title("tt1"), title("tt2")]), "title.akas": ("title_akas", [("tt1", "FR"), ("tt2", "FR")]),
             "title.ratings": ("title_ratings", [("tt1", "6.0", "5"), ("tt2", "6.0", "5")]),
             "title.principals": ("title_principals", [("tt1", "nm1", "actor"), ("tt2", "nm2", "actor"), ("tt2", "nm1", "director")]),
             "name.basics": ("name_basics", people)}
    for file, (name, rows) in world.items():
        raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS[name])).coalesce(1)
        tsv.write_raw_tsv(raw, f"{folder}/{file}.tsv")
    t = tsv.read_tables(spark, folder, ext="tsv", register=False, ordinal=True)
    p = FilmPipeline(t, as_of_year=2020, serving_actor_min=0, serving_director_min=0)
    options = {(r["facet"], r["value"]): r["label"] for r in facets.facet_options(p.serving).collect()}
    assert options["actor", "nm1"] == options["director", "nm1"] == "Bob" and options["actor", "nm2"] == "Amy"


def test_numeric_columns_are_told_by_their_cells(spark):
    rows = [("1,5", "Drama,News", "7", None, "-9999", "1e3"), ("-2", "12,5", None, None, "x", "0"), ("", "3", "", None, "2", "+4,25")]
    df = spark.createDataFrame(rows, "a string, genres string, b string, none string, mixed string, `c.d` string")
    assert sinks.numeric_columns_of(df) == ["a", "b", "c.d"]
    got = sinks.decimal_comma_cast(df.drop("c.d"))
    assert dict(got.dtypes) == {"a": "double", "genres": "string", "b": "double", "none": "string", "mixed": "string"}
    assert [r["a"] for r in got.collect()] == [1.5, -2.0, None]
    assert sinks.numeric_columns_of(df.limit(0)) == []


def test_batch_runs_write_every_output(spark):
    t = load_film_tables(spark, "/root/testdata/sf0.001")
    p = FilmPipeline(t, actor_min=5, director_min=3)
    out = p.write_statistics(scratch_path(spark, "stats"))
    assert set(out) == {"stat_global", "stat_gen_genre", "stat_gen_content", "movie", "actor",
                        "producer"}
    assert sinks.read_csv_text(spark, out["stat_global"]).count() == 1
    for path in out.values():                       # every file starts with its running index
        text = sinks.read_csv_text(spark, path)
        assert text.columns[0] == "index" and sorted(int(r[0]) for r in text.collect()) == list(range(text.count()))
    ml = p.write_ml(scratch_path(spark, "ml"))
    df = sinks.read_csv_text(spark, ml, sep=";")
    assert df.count() > 0 and df.columns[:2] == ["index", "tconst"]
    wide = sinks.read_csv_text(spark, p.write_ml(scratch_path(spark, "ml"), genres=P.GENRE_VOCABULARY), sep=";")
    assert wide.count() == df.select("tconst").distinct().count() and "name_indices" in wide.columns


def test_command_line_batch_run(spark):
    """TSV sources -> both batch runs through the command-line entry."""
    from cinespark.__main__ import main
    from cinespark.sources.fixtures import raw_film_tables

    src = scratch_path(spark, "cli-src")
    for name, df in raw_film_tables(spark, "/root/testdata/sf0.001").items():
        tsv.write_raw_tsv(df, f"{src}/{name.replace('_', '.', 1)}.tsv.gz")
    out = scratch_path(spark, "cli-out")
    got = main(["both", "--src", src, "--out", out, "--actor-min", "5", "--director-min", "3"])
    assert set(got) == {"stat_global", "stat_gen_genre", "stat_gen_content", "movie", "actor",
                        "producer", "ml"}
    genre = sinks.read_csv_text(spark, got["stat_gen_genre"]).collect()
    want = marts.genre_stats(load_film_tables(spark, "/root/testdata/sf0.001")).collect()
    assert len(genre) == len(want)
    assert {r["genre"]: r["averagerating"] for r in genre} == {
        r["genre"]: str(r["averagerating"]).replace(".", ",") for r in want}


def test_tsv_to_parquet_conversion_keeps_types_and_rows(spark):
    from cinespark.sources.fixtures import raw_film_tables

    src = scratch_path(spark, "conv-src")
    for name, df in raw_film_tables(spark, "/root/testdata/sf0.001").items():
        tsv.write_raw_tsv(df, f"{src}/{name.replace('_', '.', 1)}.tsv.gz")
    t = tsv.read_tables(spark, src, partitions=4, register=False)
    paths = tsv.to_parquet(t, scratch_path(spark, "conv-out"))
    for name, path in paths.items():
        back = spark.read.parquet(path)
        orig = getattr(t, name)
        assert back.dtypes == orig.dtypes
        assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0
