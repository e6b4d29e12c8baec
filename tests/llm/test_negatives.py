"""Operator 11 against the scores of every anchor with every row, and its bounds."""
import math

import numpy as np
import pytest

from cinespark.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score long, part string, low int"


def plain(rows):
    """Rows of the contract from all scores, in Python integers."""
    use = [(i, (y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, y in rows
           if None not in (i, y, v) and not any(x is None or not math.isfinite(x) for x in v)]
    out = []
    for a, (i, y, v) in enumerate(use):
        if i % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), j, z) for b, (j, z, w) in enumerate(use) if b != a)
        for s, j, _ in [x for x in scored if x[2] == y][:5]:
            fits = [(n, k) for n, k, z in scored if z != y and 80 * -s <= 100 * -n <= 100 * -s][:5]
            out += [(i, j, r + 1, k, -s, -n) for r, (n, k) in enumerate(fits)]
    return sorted(out)


def got(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in negatives.mine(negatives.clean_vectors(df)).collect())


@pytest.fixture(scope="module")
def awkward():
    """Clusters, a vector with many copies, a hot label, ties, repeated anchors, negative scores, odd vectors."""
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(12, 6))
    rows = [(i, (middle[i % 12] + rng.normal(size=6) * 0.3).tolist(), 1 if i % 3 == 0 else int(rng.integers(0, 10))) for i in range(1500)]
    rows += [(2000 + i, [0.5, 0.5, 0.5, 0.0, 0.0, 0.25], 3 if i % 2 else 1) for i in range(400)]
    rows += [(700, [0.5, 0.5, 0.5, 0.0, 0.0, 0.25], 3), (700, [0.5, 0.5, 0.5, 0.0, 0.0, 0.25], 3), (0, rows[0][1], rows[0][2])]
    rows += [(3000, [-1.0] * 6, 77), (3001, [1.0] * 6, 77), (3100, [], 1), (3002, [0.25, 0.5], 1), (3200, [0.0] * 6, 5),
             (None, [1.0] * 6, 1), (3300, None, 1), (3400, [1.0] * 6, None), (3500, [1.0, None], 1), (3600, [float("nan")] * 6, 1), (3700, [float("inf")] * 6, 1)]
    return rows


@pytest.mark.parametrize("slices", [1 << 15, 4])
def test_equals_all_scores(spark, awkward, monkeypatch, slices):
    monkeypatch.setattr(negatives, "SLICE", slices)
    want = plain(awkward)
    assert got(spark, awkward) == want and len(want) > 200


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 5).astype(float) * 2.0 ** 20 + rng.integers(0, 2, 5)], i % 2) for i in range(0, 600, 4)]
    want = plain(rows)
    assert got(spark, rows) == want and want


def test_few_rows_and_empty_tables(spark):
    assert got(spark, [(100, [1.0], 1)]) == [] and got(spark, [(i, [], 1) for i in (100, 200)]) == []
    rows = [(100, [1.0, 0.0], 1), (101, [0.5, 0.0], 1), (102, [0.45, 0.0], 2)]
    assert got(spark, rows) == plain(rows) == [(100, 101, 1, 102, 128 * 256, 115 * 256)]
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(negatives.clean_vectors(empty)).count() == 0


def test_bounds_hold_every_row_of_a_block():
    rng = np.random.default_rng(2)
    for exact, width in ((True, 300), (False, 1 << 40)):
        blocks = rng.integers(-width, width, (7, 20, 5))
        a = rng.integers(-width, width, (9, 5))
        least, most = negatives.score_bounds(a, blocks.min(1), blocks.max(1), exact)
        for k in range(9):
            for b in range(7):
                scores = [sum(int(x) * int(y) for x, y in zip(a[k], row)) for row in blocks[b]]
                assert least[k, b] <= min(scores) and max(scores) <= most[k, b]


def test_zone_maps_spare_blocks_of_clustered_vectors(spark, awkward):
    """Most blocks are not read where vectors cluster."""
    rng = np.random.default_rng(4)
    middle = np.abs(rng.normal(size=(30, 4))) * np.eye(4)[np.arange(30) % 4] * 4
    rows = [(i, (middle[i % 30] + rng.normal(size=4) * 0.02).tolist(), i % 10) for i in range(12_000)]
    df = negatives.clean_vectors(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA))
    sc = spark.sparkContext
    space = sc.broadcast(negatives.Space(df.select("vector").mapInArrow(
        negatives._moments, "dim long, total double, square double, most long, n long").collect()))
    blocks = negatives.zone_mapped(df, space)
    anchors = blocks.select("part", "place", "ids", "labels", "vecs").mapInArrow(negatives._anchors(space, 100), negatives.ANCHOR)
    n_blocks, n_anchors = blocks.count(), anchors.count()
    sent = anchors.withColumns({"slice": negatives.F.lit(0), "part": negatives.F.explode(negatives.F.sequence(negatives.F.lit(0), negatives.F.lit(7)))})
    zones = blocks.withColumn("slice", negatives.F.lit(0)).select("slice", "part", "place", "low", "high", "kinds")
    chosen = sent.groupBy("slice", "part").cogroup(zones.groupBy("slice", "part")).applyInArrow(
        negatives._choose(space, True), "slice int, part int, " + negatives.ANCHOR + ", n_blocks long, places array<int>")
    asked = chosen.agg({"n_blocks": "sum"}).first()[0]
    assert n_anchors == 120 and asked < 0.4 * n_anchors * n_blocks
