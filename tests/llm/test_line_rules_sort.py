"""The repeated-word count of op6 sorts in natural order, without a comparing lambda for every pair."""

from cinespark.llm.quality_rules import judge


def test_windows_are_sorted_without_a_comparator(spark):
    text = "a b c d a b c e a b c"
    rows = judge(spark.createDataFrame([(1, text), (2, None), (3, "x y")], "doc_id long, text string"))
    assert [r["n"] for r in rows.selectExpr("doc_id", "judged.n_repeat_words n").orderBy("doc_id").collect()] == [9, 0, 0]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan
