"""Plans as they run at scale: no broadcast of data-sized sides, filters at
the scan, no single-partition step over rows, a hot key of one third."""

import dataclasses

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from film_rows import film_tables, person, title
from oracle_check import compare, duck
from cinespark import queries as Q
from cinespark.plans import facets, marts
from cinespark.session import materialize_together

SF = "/root/testdata/sf0.001"
SMJ_KEYS = ["credits_base", "actor_mart", "director_mart", "stat_global", "movie_cast",
            "ml_genre_onehot", "key_numbers_both", "top_performers_filtered", "age_by_sex_genre"]


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", SMJ_KEYS)
def test_sort_merge_plans_match_oracle(spark, no_broadcast, key):
    r = compare(spark, duck(SF), key, E.queries()[key], E.oracle_sql()[key], SF)
    assert r["ok"], r


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_facet_filters_reach_the_parquet_scan(spark):
    s = Q.serving(spark, SF)
    plan = _plan(facets.facet_filter(s, genres=["blue"], decades=[1990]))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(genre,blue)" in pushed or "In(genre" in pushed
    assert "decade" in plan.split("PartitionFilters: [")[1].split("]")[0]       # only its folders are listed


def test_joins_of_serving_tables_need_no_shuffle(spark, no_broadcast):
    s = Q.serving(spark, SF)
    for df in (facets.facet_filter(s, actors=["nm0000005"]), facets.facet_filter(s, directors=["nm0000005"]),
               s.movies.select("tconst", "genre").join(s.actors.select("tconst", "sexe", "age_in_movie"), "tconst")):
        plan = _plan(df)
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(tconst" not in plan, plan
    assert _plan(facets.age_by_sex(s)).count("Exchange hashpartitioning(tconst") == 0
    assert _plan(facets.top_performers(s)).count("Exchange hashpartitioning(tconst") == 0


def test_hot_film_keeps_the_tables_unbucketed(spark):
    hot = spark.range(20_000).select(F.lit("tt1").alias("tconst"), (F.col("id") % 3 * 10 + 1990).cast("int").alias("decade"))
    cold = spark.range(20_000).select(F.concat(F.lit("tt"), "id").alias("tconst"), F.lit(1990).alias("decade"))
    for first, bucketed in ((hot, False), (cold, True)):
        kept = materialize_together({"a": first, "b": cold}, "tconst", "decade", {})
        assert kept["a"].exceptAll(first).count() == 0 and kept["a"].count() == 20_000 and kept["a"].columns == first.columns
        plan = _plan(kept["a"].groupBy("tconst").count())
        assert ("Exchange" not in plan) == bucketed


def test_a_third_of_all_people_prunes_the_scan(spark, no_broadcast):
    """The Bloom filter of the selected ids stands on the scan of the serving table."""
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    try:
        s = Q.serving(spark, SF)
        df = Q.QUERIES["facet_filter_third"](spark, SF)
        assert "might_contain" in df._jdf.queryExecution().optimizedPlan().toString()
        third = sorted({r[0] for r in s.actors.select("Nconst").collect() if int(r[0][2:]) % 3 == 0})
        wanted = facets.facet_filter(s, genres=Q.G, actors=third).collect()
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, wanted))
        long = [*third, *(f"nm{i:09d}" for i in range(5000)), None]                # a long list: a semi join on ids
        plan = facets.select_people(s.actors, long)
        assert "SEMI" in plan._jdf.queryExecution().optimizedPlan().toString().upper()
        assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, s.actors.filter(F.col("Nconst").isin(third)).collect()))
    finally:
        spark.conf.unset("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold")


def test_views_without_people_read_the_cube_only(spark):
    s = Q.serving(spark, SF)
    films = dataclasses.replace(s, cube=None)
    for chosen in ({}, {"genres": Q.G}, {"decades": Q.D, "notes": Q.N}, {"genres": Q.G, "decades": Q.D, "notes": Q.N}, {"genres": ["none"]}):
        for view in (lambda x: facets.key_numbers(x, **chosen), lambda x: facets.count_by(x, "genre", **chosen),
                     lambda x: facets.count_by(x, "decade", **chosen), lambda x: facets.rating_votes(x, **chosen),
                     lambda x: facets.rating_votes(x, view="decade", **chosen), lambda x: facets.runtime_by(x, **chosen),
                     lambda x: facets.runtime_by(x, view="decade", **chosen)):
            a, b = view(s), view(films)
            assert a.schema.simpleString() == b.schema.simpleString() and a.collect() == b.collect()
    files = lambda df: {f.rsplit("/", 2)[-2].rsplit("-", 5)[0] for f in df.inputFiles()}
    assert files(facets.rating_votes(s, genres=Q.G)) == {"facet_cube"}


def test_actor_mart_has_no_single_partition_step(spark):
    plan = _plan(marts.actor_mart(Q.credits(spark, SF)))
    assert "SinglePartition" not in plan
    # per-person counts are an aggregate, not a window count over credit rows
    assert "count(1) windowspecdefinition" not in plan.replace("\n", " ")


def test_hot_person_holding_a_third_of_all_credits(spark):
    titles = [title(f"tt{i:05d}", year=str(1950 + i % 60)) for i in range(600)]
    principals = [(f"tt{i:05d}", "nm00000", "actor") for i in range(0, 600, 3)]
    principals += [(f"tt{i:05d}", f"nm{1 + i % 40:05d}", "actress" if i % 2 else "actor")
                   for i in range(600) if i % 3]
    people = [person(f"nm{i:05d}", name=f"P{i % 30}") for i in range(41)]
    t = film_tables(spark, title_basics=titles, title_akas=[(x[0], "FR") for x in titles],
                    title_ratings=[(x[0], "6.0", "5") for x in titles],
                    title_principals=principals, name_basics=people)
    got = marts.actor_mart(marts.credits_base(t)).toPandas()
    assert (got["Nconst"] == "nm00000").sum() == len(got) // 3
    # brute force in pandas on the credit rows
    c = marts.credits_base(t).toPandas()
    c = c[c["category"].isin(["actor", "actress"])].copy()
    c["nb_film"] = c.groupby("nconst")["tconst"].transform("count")
    c["rank"] = 0
    for sx in (0, 1):
        m = c["sexe"] == sx
        c.loc[m, "rank"] = c.loc[m, "nb_film"].rank(method="dense", ascending=False).astype(int)
    c["film_per_decade"] = c.groupby(["primaryName", "decade"])["tconst"].transform("count")
    want = c.rename(columns={"nconst": "Nconst"})[["Nconst", "tconst", "nb_film", "rank",
                                                  "film_per_decade"]]
    got = got[["Nconst", "tconst", "nb_film", "rank", "film_per_decade"]]
    key = ["Nconst", "tconst"]
    pd.testing.assert_frame_equal(
        got.sort_values(key).reset_index(drop=True).astype("int64", errors="ignore"),
        want.sort_values(key).reset_index(drop=True).astype("int64", errors="ignore"),
        check_dtype=False)


@pytest.fixture()
def skew_conf(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot_tables(spark):
    titles = [title(f"tt{i:05d}", year="1990") for i in range(3000)]
    principals = [(f"tt{i:05d}", "nm00000", "actor") for i in range(2000)]
    principals += [(f"tt{i:05d}", f"nm{1 + i % 50:05d}", "director") for i in range(2000, 3000)]
    return film_tables(spark, title_basics=titles, title_akas=[(x[0], "FR") for x in titles],
                       title_ratings=[(x[0], "6.0", "5") for x in titles],
                       title_principals=principals, name_basics=[person(f"nm{i:05d}") for i in range(51)])


def test_hot_person_of_stored_credits_is_dealt_to_several_tasks(spark, no_broadcast):
    """M7, M8, M9 on stored credits: the person join deals a hot person out by
    hand, whatever the settings are."""
    from cinespark.operators.salting import SALTS
    from cinespark.plans import features
    from cinespark.session import materialize

    credits = materialize(marts.credits_base(hot_tables(spark)), "hot")
    for df in (features.cast_distribution(credits, 1, 1), marts.actor_mart(credits), marts.director_mart(credits)):
        assert "__salt" in _plan(df).split("SortMergeJoin [nconst")[1].split("\n")[0]
    got = features.cast_distribution(credits, 1, 1).collect()
    assert len(got) == 3000 and {r["nb_film"] for r in got if r["primaryName"] == "P nm00000"} == {2000}
    dealt = credits.withColumn("s", F.pmod(F.xxhash64(*credits.columns), F.lit(SALTS))).groupBy("nconst", "s").count()
    assert dealt.agg(F.max("count")).first()[0] < 2000 / 4


def test_credit_join_is_split_at_runtime(spark, skew_conf):
    """M1: both sides of the person join are plain shuffles, so AQE splits it
    without forceOptimizeSkewedJoin."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    try:
        df = marts.credits_base(hot_tables(spark))
        assert len(df.collect()) == 3000
        final = _plan(df).split("Initial Plan")[0]
        assert "SortMergeJoin(skew=true) [nconst" in final
    finally:
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def test_scans_read_only_what_they_use(spark):
    s = Q.serving(spark, SF)
    schema = _plan(facets.count_by(dataclasses.replace(s, cube=None), "genre", genres=["blue"], notes=[5])).split("ReadSchema: ")[1].split("\n")[0]
    assert schema == "struct<averagerating:double,genre:string>"
    plan = _plan(facets.age_by_sex(s, genres=["blue"]))
    assert "primaryName" not in plan and "film_per_decade" not in plan
    for key, part in (("serving_scan_movie", "GreaterThan(decade,0)"), ("serving_scan_actor", "GreaterThan(nb_film"),
                      ("serving_scan_director", "GreaterThan(age,0)")):
        plan = _plan(Q.QUERIES[key](spark, SF))
        assert part in plan and "Join" not in plan and "Exchange" not in plan


def test_materialize_is_one_write(spark):
    from cinespark.session import materialize
    spark.sparkContext.setJobGroup("one-write", "")
    materialize(spark.range(100).repartition(3).groupBy((F.col("id") % 7).alias("k")).count())
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one-write")
    spark.sparkContext.setJobGroup("plain", "")
    spark.range(100).repartition(3).groupBy((F.col("id") % 7).alias("k")).count().write.format("noop").mode("overwrite").save()
    assert len(jobs) == len(spark.sparkContext.statusTracker().getJobIdsForGroup("plain"))
    spark.sparkContext.setJobGroup("rest", "")


def test_a_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace
    from cinespark.session import checkpoint_dir
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError):
        checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


def test_tables_are_derived_when_asked_for_and_again_when_the_input_changes(spark, tmp_path):
    import os
    import shutil
    from cinespark.plans.catalog import load_film_tables
    src = tmp_path / "in"
    shutil.copytree(SF, src)
    os.chmod(src, 0o755)
    one = load_film_tables(spark, str(src))
    assert one.title_ratings.count() > 0 and set(one._kept) == {"title_ratings"}
    assert load_film_tables(spark, str(src)) is one
    os.utime(src / "part.parquet", (1, 1))
    assert load_film_tables(spark, str(src)) is not one


def test_long_ids_stay_apart(spark):
    from cinespark.sources import fixtures
    from cinespark.oracles import FIXTURE_CTES
    keys = [7, 1_000_000, 10_000_000, 10_000_009, 123_456_789_012]
    df = spark.createDataFrame([(k,) for k in keys], "p_partkey long").select(fixtures._id("tt", F.col("p_partkey")).alias("i"))
    got = [r.i for r in df.collect()]
    expr = FIXTURE_CTES.split("SELECT ")[1].split(" AS tconst")[0]
    con = duck(SF)
    want = [con.execute(f"SELECT {expr} FROM (SELECT {k}::BIGINT AS p_partkey)").fetchone()[0] for k in keys]
    assert got == want and len(set(got)) == 5 and got[0] == "tt0000007" and got[-1] == "tt123456789012"


def test_no_registered_plan_has_a_cross_join(spark):
    """Every join of every registered query is an equi-join: no cartesian
    product and no nested-loop join, even with broadcasts off."""
    bad = {}
    q = Q.QUERIES
    for key in q:
        df = q[key](spark, SF)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = _plan(df)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        found = [w for w in ("CartesianProduct", "NestedLoopJoin") if w in plan]
        if found:
            bad[key] = found
    assert bad == {}


def test_materialized_tables_live_in_the_configured_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    stored = [*Q.tables(spark, SF).as_dict().values(), Q.credits(spark, SF)]
    for df in stored:
        files = df.inputFiles()
        assert files and all(f.split(":", 1)[-1].lstrip("/").startswith(base.lstrip("/"))
                             for f in files)
