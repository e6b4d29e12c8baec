"""Dense numbering, pages by number and sparse vectors on small and awkward tables."""
import random

import pytest
from pyspark.sql import functions as F

from cinespark import queries as Q
from cinespark.operators.numbering import with_dense_index
from cinespark.operators.paging import PageIndex
from cinespark.plans import facets, features

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dense_index_equals_the_sorted_place(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), f"k{i:04d}") for i in range(700)] + [(9, f"h{i:04d}") for i in range(400)]
    df = spark.createDataFrame(rows, "__part int, k string").repartition(7)   # a clashing column name, a hot value
    got = with_dense_index(df, [F.col("__part").desc_nulls_last(), F.col("k")], partitions=5)
    assert got.columns == ["__part", "k", "index"]
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [tuple(r) for r in got.orderBy("index").collect()] == [(*r, i) for i, r in enumerate(want)]
    assert with_dense_index(df.limit(0), ["k"]).count() == 0
    same = spark.createDataFrame([(1,)] * 50, "x int")                        # repeated rows have a place each
    assert sorted(r["index"] for r in with_dense_index(same, ["x"]).collect()) == list(range(50))


@pytest.fixture(scope="module")
def numbers(spark):
    rows = [(i, "abc"[i % 3], i % 7) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, kind string, week int")
    return rows, PageIndex(df, [("week", True), ("id", False)], 10, ["kind", "week"], block_pages=4)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 57, 99, 100])
def test_any_page_equals_offset(numbers, n):
    rows, pages = numbers
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert [tuple(r) for r in pages.page(n).collect()] == order[10 * n:10 * n + 10]
    some = [r for r in order if r[1] == "b" and r[2] in (0, 5)]
    keep = (F.col("kind") == "b") & F.col("week").isin(0, 5)
    assert [tuple(r) for r in pages.page(n, keep).collect()] == some[10 * n:10 * n + 10]


def test_a_page_reads_one_block(numbers):
    _, pages = numbers
    assert "PartitionFilters: [isnotnull(__block" in _plan(pages.page(57))
    df = pages.page(3, F.col("kind") == "b")
    assert "dynamicpruning" in _plan(df).lower()
    blocks = {r[0] for r in pages.rows.filter(F.col("kind") == "b").join(df.select("id"), "id").select("__block").distinct().collect()}
    assert len(blocks) <= 2


def test_pages_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, kind string")
    pages = PageIndex(df, [("id", False)], 10, ["kind"])
    assert pages.page(0).collect() == [] and pages.page(2, F.col("kind") == "a").collect() == []


def test_film_pages_follow_the_key_set_pages(spark):
    s, pages = Q.serving(spark, SF), Q.pipeline(spark, SF).film_pages
    last = None
    for n in range(3):
        got = facets.movie_table(s, decades=[1970, 1980, 1990], after=last).collect()
        jumped = facets.movie_table_page(pages, n, decades=[1970, 1980, 1990]).collect()
        assert [r.tconst for r in got] == [r.tconst for r in jumped]
        last = got[-1].asDict() if got else None


def test_sparse_plan_has_no_single_task_over_rows(spark):
    p = Q.pipeline(spark, SF)
    plan = _plan(features.ml_sparse(p.movie_cast, p.name_vocabulary))
    assert "SinglePartition" not in plan and "__salt" in plan
