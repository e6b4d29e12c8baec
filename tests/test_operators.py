"""The reusable operators against pandas, on generated inputs."""

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinespark.operators import dense_rank_desc, one_hot, page_after, top_k, with_group_count

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 6)),
                   min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(rows=rows_st)
def test_dense_rank_desc_equals_pandas(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int")
    got = sorted(((r["k"], r["v"], r["rank"]) for r in
                  dense_rank_desc(df, "v", ["k"]).collect()), key=repr)
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    pdf["rank"] = (pdf.groupby(pdf["k"].fillna("<null>"))["v"]
                   .rank(method="dense", ascending=False).astype(int))
    want = sorted(((None if pd.isna(k) else k, int(v), int(r))
                   for k, v, r in pdf.itertuples(index=False)), key=repr)
    assert got == want


@settings(max_examples=8, deadline=None)
@given(rows=rows_st)
def test_group_count_equals_pandas_transform(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int")
    got = sorted(((r["k"], r["v"], r["n"]) for r in
                  with_group_count(df, ["k", "v"], "n").collect()), key=repr)
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    pdf["n"] = pdf.groupby(["k", "v"])["v"].transform("count")
    want = sorted(((None if pd.isna(k) else k, int(v), None if pd.isna(n) else int(n))
                   for k, v, n in pdf.itertuples(index=False)), key=repr)
    assert got == want


def test_one_hot_with_fixed_vocabulary(spark):
    df = spark.createDataFrame([("f1", "x"), ("f1", "y"), ("f2", None), ("f3", "w")],
                               "film string, feature string")
    got = {r["film"]: (r["x"], r["y"], r["w"]) for r in
           one_hot(df, ["film"], "feature", ["w", "x", "y"]).collect()}
    assert got == {"f1": (1, 1, 0), "f2": (0, 0, 0), "f3": (0, 0, 1)}
    with pytest.raises(Exception, match="not in the vocabulary"):
        one_hot(df, ["film"], "feature", ["x", "y"]).collect()


@settings(max_examples=5, deadline=None)
@given(vals=st.lists(st.integers(0, 20), min_size=1, max_size=60), size=st.integers(1, 7))
def test_pages_and_top_k_follow_the_total_order(spark, vals, size):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v int")
    order = [F.col("v").desc(), F.col("id").asc()]
    want = sorted(enumerate(vals), key=lambda t: (-t[1], t[0]))
    assert [tuple(r) for r in top_k(df, order, size).collect()] == want[:size]
    by = [("v", True), ("id", False)]
    first = page_after(df, by, size).collect()
    assert [tuple(r) for r in first] == want[:size]
    nxt = page_after(df, by, size, first[-1].asDict())
    assert [tuple(r) for r in nxt.collect()] == want[size:2 * size]
