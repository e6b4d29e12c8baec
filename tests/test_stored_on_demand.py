"""Serving tables are made when a view reads them; a repeated small side is not broadcast; long files are parted."""

from pyspark.sql import functions as F

from cinespark import fixture_params as P
from cinespark.operators.salting import salted_join
from cinespark.plans import facets
from cinespark.plans.catalog import load_film_tables
from cinespark.plans.pipeline import FilmPipeline
from cinespark.session import StoredTogether
from cinespark.sources import tsv

SF = "/root/testdata/sf0.001"


def _pipeline(spark) -> FilmPipeline:
    return FilmPipeline(load_film_tables(spark, SF), as_of_year=P.AS_OF_YEAR, serving_director_min=P.DIRECTOR_SERVING_MIN)


def test_a_view_makes_only_the_tables_it_reads(spark):
    p = _pipeline(spark)
    facets.movie_table(p.serving, genres=P.GENRES).collect()
    assert "movie_mart" in vars(p) and not {"credits", "actor_mart", "director_mart", "cube"} & set(vars(p))
    s = p.serving
    facets.key_numbers(s, directors=s.directors.filter(F.col("rank") <= P.SELECT_RANK).select("Nconst")).collect()
    assert "director_mart" in vars(p) and not {"actor_mart", "cube"} & set(vars(p))
    assert s.actors.count() == p.scan_actors().na.drop().count()
    assert s.cube.filter("level = 7").first()["n"] == s.movies.count()


def test_a_hot_film_opened_first_unbuckets_the_films(spark):
    films = spark.range(20_000).select(F.concat(F.lit("tt"), "id").alias("tconst"), F.lit(1990).alias("decade"))
    hot = spark.range(20_000).select(F.lit("tt1").alias("tconst"), F.lit(1990).alias("decade"))
    kept = StoredTogether({"films": lambda: films, "hot": lambda: hot}, "tconst", "decade", {})

    def exchanges() -> bool:
        return "Exchange" in kept["films"].groupBy("tconst").count()._jdf.queryExecution().executedPlan().toString()

    assert not exchanges()
    assert kept["hot"].count() == 20_000
    assert exchanges() and kept["films"].exceptAll(films).count() == 0


def test_the_repeated_side_is_shuffled(spark):
    rows = spark.range(2000).select((F.col("id") % 7).alias("k"), "id")
    counts = rows.groupBy("k").count()
    for how in ("inner", "left"):
        joined = salted_join(rows, counts, ["k"], how)
        assert joined.count() == 2000 and joined.filter("count not in (285, 286)").count() == 0
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan


def test_a_long_file_is_parted_and_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tsv, "FILE_ROWS", 100)
    rows = spark.range(950).select(F.col("id").cast("string").alias("a"), F.lit("x y").alias("b"))
    tsv.write_raw_tsv(rows.coalesce(1), f"{tmp_path}/t.tsv.gz")
    assert len(list((tmp_path / "t.tsv.gz").glob("*.csv.gz"))) == 10
    back = tsv.read_raw_tsv(spark, f"{tmp_path}/t.tsv.gz")
    assert back.rdd.getNumPartitions() > 1
    assert back.exceptAll(rows).count() == 0 and back.count() == 950
