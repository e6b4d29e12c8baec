"""The pipeline's filter by classes on repeated and null doc_ids."""
import random

from cinespark.llm import jaccard_join

SCHEMA = "doc_id long, text string, kept int"


def text(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def kept(spark, rows, parts):
    return sorted((tuple(r) for r in jaccard_join.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()), key=repr)


def test_one_row_of_each_class(spark):
    """Different texts under null or one doc_id all stay; of copies the one with the least doc_id stays."""
    near = text(1).split()
    near[59] = "changed"
    rows = [(None, text(k), 0) for k in range(20, 26)] + [(7, text(30), 1), (7, text(31), 1), (7, text(31), 1)]
    rows += [(1, text(1), 2), (2, " ".join(near), 2), (2, text(2), 2), (None, text(1), 2), (9, text(22), 3)]
    want = [(None, text(k), 0) for k in (20, 21, 23, 24, 25)] + [(7, text(30), 1), (7, text(31), 1), (1, text(1), 2), (2, text(2), 2), (9, text(22), 3)]
    for parts in (1, 4):
        assert kept(spark, rows, parts) == sorted(want, key=repr)
    assert jaccard_join.keep_one(spark.createDataFrame(rows, SCHEMA)).columns == ["doc_id", "text", "kept"]


def test_texts_without_a_word_are_one_class(spark):
    assert kept(spark, [(3, "", 0), (None, None, 0), (4, " \n", 0)], 2) == [(3, "", 0)]
