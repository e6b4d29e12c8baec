"""Operator 11, hard-negative mining over zone-mapped blocks along a Hilbert curve.

Vectors become integers and are range-sorted by the Hilbert key of their CURVE_DIMS most varied dimensions
(ties by id, so copies are spread), then stored in Parquet as blocks of BLOCK rows with the least and greatest
value of every dimension (the zone map) and the labels that occur. Interval arithmetic on a zone map bounds
the score of any of its rows with an anchor from both sides. Two rounds follow, each in two steps: the zone
maps alone tell which blocks an anchor's windows must read, then only blocks that some anchor asked for are
read, and their scores are computed exactly.

Round one looks for an anchor's positives: its window starts at the score that the POSITIVES-th row of its own
block has. Round two looks for the negatives: each positive has a window from LEAST % of its score up to it.
In both, a task keeps the first rows of each window, and the first of all tasks meet in a window function that
is limited in each task before the shuffle.

Anchors (ids divisible by ANCHORS) are the stated query set. They meet range partitions of blocks: every anchor
is sent to each partition once a round, in slices of about SLICE anchors, which bounds what a task holds; of the
blocks only chosen ones are sent. The moments of the dimensions, one row each, are all that reaches the driver.

Defined results: rows with a null id, label or vector, or any null or non-finite component take no part; a
shorter vector has zeros at its end; equal rows count each (an anchor's copy is another row); components beyond
64 bits are cut to them, scores likewise; without a positive or negative there is no row; an empty table gives
no rows; other columns are not needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinespark.llm.common import partitions, stored, table
from cinespark.llm.packing import hilbert

ANCHORS = 100
POSITIVES = NEGATIVES = 5
LEAST = 80                 # a negative's score is at least this share of the positive's, in per cent
SCALE = 256
BLOCK = 128
CURVE_DIMS, CURVE_BITS = 8, 7
PART_ROWS = 1 << 16
SLICE = 1 << 15
TILE = 1 << 12
HIGH = (1 << 63) - 1


# -- vectors ------------------------------------------------------------------------------------

def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Integer components of a batch of lists, zeros at the end of shorter ones."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    values = np.clip(values, -float(1 << 62), float(1 << 62)).astype(np.int64)
    out = np.zeros((len(column), dims), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _moments(batches):
    n, dims, most = 0, 0, 0
    total, square = np.zeros(0), np.zeros(0)
    for batch in batches:
        lengths = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
        v = _matrix(batch.column(0), int(lengths.max(initial=0)))
        if v.shape[1] > dims:
            total, square = np.pad(total, (0, v.shape[1] - dims)), np.pad(square, (0, v.shape[1] - dims))
            dims = v.shape[1]
        most = max(most, int(np.abs(v).max(initial=0)))
        n += len(v)
        total[:v.shape[1]] += v.sum(0, dtype=np.float64)
        square[:v.shape[1]] += (v.astype(np.float64) ** 2).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(total), pa.array(square), pa.array([most] * dims, pa.int64()),
                                      pa.array([n] * dims, pa.int64())], names=["dim", "total", "square", "most", "n"])


class Space:
    """Width of the components, and the dimensions of the curve with their middle and spread."""

    def __init__(self, rows):
        rows = sorted(tuple(r) for r in rows)
        self.dims = len(rows)
        most = max((r[3] for r in rows), default=0)
        self.dtype = np.dtype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")
        self.exact = max(self.dims, 1) * most * most < 1 << 53       # sums of products are exact in doubles
        mean = np.array([r[1] / max(r[4], 1) for r in rows])
        spread = np.sqrt(np.maximum(np.array([r[2] / max(r[4], 1) for r in rows]) - mean ** 2, 0))
        self.on = np.sort(np.argsort(-spread, kind="stable")[:CURVE_DIMS])
        self.mean, self.spread = mean[self.on], np.maximum(spread[self.on], 1e-9)

    def keys(self, v: np.ndarray) -> np.ndarray:
        if not len(self.on):
            return np.zeros(len(v), np.int64)
        cells = np.floor(((v[:, self.on] - self.mean) / self.spread + 2.5) / 5 * (1 << CURVE_BITS))
        cells = np.clip(cells, 0, (1 << CURVE_BITS) - 1).astype(np.int64)
        return (hilbert(cells, CURVE_BITS) if len(self.on) > 1 else cells[:, 0]).astype(np.int64)

    def rows(self, blobs: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), self.dtype).reshape(-1, self.dims) if self.dims else np.zeros((len(blobs), 0), self.dtype)

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products of the rows of a and b as 64-bit integers."""
        if self.exact:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        whole = a.astype(object) @ b.astype(object).T if self.dims else np.zeros((len(a), len(b)), object)
        return np.array([[max(-HIGH, min(HIGH, x)) for x in r] for r in whole.tolist()], np.int64).reshape(len(a), len(b))


def _keyed(space):
    def run(batches):
        s = space.value
        for batch in batches:
            v = _matrix(batch.column(2), s.dims)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s.keys(v)),
                                              pa.array([x.tobytes() for x in v.astype(s.dtype)], pa.binary())], names=["vec_id", "label", "key", "vec"])
    return run


def _blocks(space):
    """Consecutive rows as blocks: part (range partition), place in it, rows, zone map and labels."""
    def block(part, place, ids, labels, vecs):
        v = space.value.rows(vecs)
        by = np.argsort(ids, kind="stable")                          # smaller ids first, for ties
        return (part, place, ids[by].tobytes(), labels[by].tobytes(), v[by].tobytes(), v.min(0).tobytes(), v.max(0).tobytes(), np.unique(labels).tobytes())

    def batch_of(rows):
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(8)],
                                          names=["part", "place", "ids", "labels", "vecs", "low", "high", "kinds"])

    def run(batches):
        part, place, ids, labels, vecs = TaskContext.get().partitionId(), 0, [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
            vecs += batch.column(3).to_pylist()
            out = []
            while len(ids) >= BLOCK:
                out.append(block(part, place, np.array(ids[:BLOCK], "<i8"), np.array(labels[:BLOCK], "<i8"), vecs[:BLOCK]))
                ids, labels, vecs, place = ids[BLOCK:], labels[BLOCK:], vecs[BLOCK:], place + 1
            if out:
                yield batch_of(out)
        if ids:
            yield batch_of([block(part, place, np.array(ids, "<i8"), np.array(labels, "<i8"), vecs)])
    return run


def zone_mapped(rows: DataFrame, space) -> DataFrame:
    """Blocks of the rows (vec_id, label, vector) along the curve, stored."""
    spark = rows.sparkSession
    parts = max(partitions(spark), rows.count() // PART_ROWS + 1)
    keyed = rows.mapInArrow(_keyed(space), "vec_id long, label long, key long, vec binary")
    return stored(keyed.repartitionByRange(parts, "key", "vec_id").sortWithinPartitions("key", "vec_id").mapInArrow(
        _blocks(space), "part int, place int, ids binary, labels binary, vecs binary, low binary, high binary, kinds binary"))


# -- anchors and their windows ------------------------------------------------------------------

ANCHOR = "anchor long, anchor_id long, label long, vec binary, lows array<long>, highs array<long>"


def _anchors(space, every: int):
    """Anchors among the rows of blocks, with the window of their positives."""
    def run(batches):
        s = space.value
        for batch in batches:
            rows = []
            for part, place, ids, labels, vecs in zip(*(batch.column(k).to_pylist() for k in range(5))):
                ids, labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
                at = np.flatnonzero(ids % every == 0)
                if not len(at):
                    continue
                v = s.rows([vecs])
                score = s.products(v[at], v)
                for i, row in zip(at.tolist(), score):
                    same = labels == labels[i]
                    same[i] = False
                    own = np.sort(row[same])
                    rows.append(((part << 44 | place << 16) + i, int(ids[i]), int(labels[i]), v[i].tobytes(),
                                 [int(own[-POSITIVES]) if len(own) >= POSITIVES else -HIGH], [HIGH]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = ["anchor", "anchor_id", "label", "vec", "lows", "highs"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(6)], names=names)
    return run


def score_bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray, exact: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that an anchor (row of a) can have with a row between low and high (rows: zone maps)."""
    kind = np.float64 if exact else object
    up, down, low, high = np.maximum(a, 0).astype(kind), np.minimum(a, 0).astype(kind), low.astype(kind).T, high.astype(kind).T
    if not a.shape[1]:
        return np.zeros((len(a), low.shape[1])), np.zeros((len(a), low.shape[1]))
    return up @ low + down @ high, up @ high + down @ low


def _choose(space, same: bool):
    """Which blocks of a range partition the windows of a slice of anchors must read, by the zone maps alone."""
    def run(key, left, right):
        s = space.value
        rows, wanted = [], []
        if left.num_rows and right.num_rows:
            place = right.column("place").to_numpy()
            low, high = s.rows(right.column("low").to_pylist()), s.rows(right.column("high").to_pylist())
            kinds = [np.frombuffer(k, "<i8") for k in right.column("kinds").to_pylist()]
            label = left.column("label").to_numpy()
            anchor = s.rows(left.column("vec").to_pylist())
            names, which = np.unique(np.concatenate(kinds), return_inverse=True)
            has = np.zeros((len(names) + 1, len(kinds)), bool)       # the last row: a label that no block has
            has[which, np.repeat(np.arange(len(kinds)), [len(k) for k in kinds])] = True
            row = np.searchsorted(names, label)
            row[(row == len(names)) | (names[np.minimum(row, len(names) - 1)] != label)] = len(names)
            lows, highs = left.column("lows").to_pylist(), left.column("highs").to_pylist()
            for i in range(0, len(label), 256):
                least, most = score_bounds(anchor[i:i + 256], low, high, s.exact)
                some = has[row[i:i + 256]]
                if not same:
                    some = has.sum(0)[None, :] > some                # a label other than the anchor's
                for k in range(len(least)):
                    hit = np.zeros(len(place), bool)
                    for a, b in zip(lows[i + k], highs[i + k]):
                        hit |= (most[k] >= a) & (least[k] <= b)
                    hit &= some[k]
                    if hit.any():
                        rows.append(i + k)
                        wanted.append(hit)
        union = np.logical_or.reduce(wanted) if wanted else np.zeros(0, bool)
        out = left.take(pa.array(rows, pa.int64())).select(["slice", "part", "anchor", "anchor_id", "label", "vec", "lows", "highs"])
        out = out.append_column("n_blocks", pa.array([int(w.sum()) for w in wanted], pa.int64()))
        out = out.append_column("places", pa.array([None] * len(rows), pa.list_(pa.int32())))
        if wanted:                                                   # one row more: the blocks that any of them must read
            more = {n: [None] for n in out.schema.names} | {"slice": [key[0].as_py()], "part": [key[1].as_py()], "places": [place[union].tolist()]}
            out = pa.concat_tables([out, pa.table(more, schema=out.schema)])
        return out
    return run


def _read(space, same: bool, first: int):
    """The first rows of each window among the chosen blocks."""
    def run(key, left, right):
        s = space.value
        found = []
        if left.num_rows and right.num_rows:
            size = [len(x) // 8 for x in right.column("ids").to_pylist()]
            ids = np.frombuffer(b"".join(right.column("ids").to_pylist()), "<i8")
            labels = np.frombuffer(b"".join(right.column("labels").to_pylist()), "<i8")
            rows = s.rows([b"".join(right.column("vecs").to_pylist())]) if s.dims else np.zeros((len(ids), 0), s.dtype)
            own = np.concatenate([(int(p) << 44 | int(b) << 16) + np.arange(n) for p, b, n in zip(
                right.column("part").to_pylist(), right.column("place").to_pylist(), size)])
            by = np.argsort(ids, kind="stable")
            ids, labels, rows, own = ids[by], labels[by], rows[by], own[by]
            anchor, anchor_id, label = (left.column(c).to_numpy() for c in ("anchor", "anchor_id", "label"))
            vecs = s.rows(left.column("vec").to_pylist())
            lows, highs = left.column("lows").to_pylist(), left.column("highs").to_pylist()
            for i in range(0, len(anchor), 256):
                j = min(len(anchor), i + 256)
                for w in range(max(map(len, lows[i:j]))):
                    use = np.array([k for k in range(i, j) if len(lows[k]) > w])
                    found += [(int(anchor[k]), int(anchor_id[k]), w, int(ids[r]), int(x)) for k, r, x in _window(
                        s, vecs[use], label[use], anchor[use], np.array([lows[k][w] for k in use]), np.array([highs[k][w] for k in use]),
                        rows, labels, ids, own, same, first, use)]
        names = ["anchor", "anchor_id", "window", "vec_id", "score"]
        return pa.table({n: pa.array([f[k] for f in found], pa.int32() if n == "window" else pa.int64()) for k, n in enumerate(names)})
    return run


def _window(s, vecs, label, anchor, low, high, rows, labels, ids, own, same, first, use):
    """(anchor, row, score) of the ``first`` best rows between low and high for each anchor; rows are in order of their ids."""
    low = low.copy()
    held = [np.zeros(0, np.int64)] * 3                               # anchor, row, score
    for t in range(0, len(ids), TILE):
        score = s.products(vecs, rows[t:t + TILE])
        fits = (score >= low[:, None]) & (score <= high[:, None])
        fits &= (labels[None, t:t + TILE] == label[:, None]) if same else (labels[None, t:t + TILE] != label[:, None])
        if same:
            fits &= own[None, t:t + TILE] != anchor[:, None]
        a, r = np.nonzero(fits)
        held = [np.concatenate(x) for x in zip(held, (a, r + t, score[a, r]))]
        by = np.lexsort((held[1], -held[2], held[0]))
        held = [x[by] for x in held]
        start = np.searchsorted(held[0], np.arange(len(vecs)))
        place = np.arange(len(by)) - start[held[0]]
        last = place == first - 1
        low[held[0][last]] = np.maximum(low[held[0][last]], held[2][last])   # what scores less cannot be among the first
        held = [x[place < first] for x in held]
    return zip(use[held[0]].tolist(), held[1].tolist(), held[2].tolist())


def _probe(anchors: DataFrame, blocks: DataFrame, space, same: bool, first: int) -> DataFrame:
    """(anchor, anchor_id, window, vec_id, score, rank) of the first rows of each anchor's windows."""
    parts = (blocks.agg(F.max("part")).first()[0] or 0) + 1
    slices = anchors.count() // SLICE + 1
    sent = (anchors.withColumn("slice", F.pmod(F.xxhash64("anchor"), F.lit(slices)).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    spread = blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    chosen = stored(sent.groupBy("slice", "part").cogroup(spread.select("slice", "part", "place", "low", "high", "kinds").groupBy("slice", "part"))
                    .applyInArrow(_choose(space, same), "slice int, part int, " + ANCHOR + ", n_blocks long, places array<int>"))
    asked = chosen.filter("places is not null").select("slice", "part", F.explode("places").alias("place"))
    read = spread.select("slice", "part", "place", "ids", "labels", "vecs").join(asked, ["slice", "part", "place"], "left_semi")
    hits = (chosen.filter("places is null").groupBy("slice", "part").cogroup(read.groupBy("slice", "part"))
            .applyInArrow(_read(space, same, first), "anchor long, anchor_id long, window int, vec_id long, score long"))
    by = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= first)


def mine(rows: DataFrame, every: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, label, vector) of clean vectors."""
    sc = rows.sparkSession.sparkContext
    moments = (rows.select("vector").mapInArrow(_moments, "dim long, total double, square double, most long, n long")
               .groupBy("dim").agg(F.sum("total"), F.sum("square"), F.max("most"), F.sum("n")).collect())
    space = sc.broadcast(Space(moments))
    blocks = zone_mapped(rows, space)
    anchors = stored(blocks.select("part", "place", "ids", "labels", "vecs").mapInArrow(_anchors(space, every), ANCHOR))
    positives = stored(_probe(anchors, blocks, space, True, POSITIVES))
    # 100 * n >= LEAST * p  <=>  n >= p - floor((100 - LEAST) * p / 100), without an overflow for p >= 0
    above = F.expr(f"score - (score div 100 * {100 - LEAST} + score % 100 * {100 - LEAST} div 100)")
    windows = positives.filter("score >= 0").withColumn("low", above).groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "low", "score"))).alias("w")).select(       # at most POSITIVES
        "anchor", F.col("w.rank").alias("places"), F.col("w.low").alias("lows"), F.col("w.score").alias("highs"))
    asking = stored(anchors.drop("lows", "highs").join(windows, "anchor"))
    negatives = _probe(asking.drop("places"), blocks, space, False, NEGATIVES)
    pairs = positives.select("anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(pairs, ["anchor", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def clean_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, with the label of the contract."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return (embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").alias("vector")))


def op11_zone_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(clean_vectors(table(spark, sf_dir, "embeddings")))


#: The same rows from the scores of every anchor with every row.
ORACLE = f"""
WITH e AS (SELECT row_number() OVER () AS k, vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
       [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
       WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
         AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c AS (SELECT k, unnest(v) AS x, unnest(range(len(v))) AS dim FROM e),
s AS (SELECT a.k AS ak, b.k AS bk, sum(a.x * b.x)::BIGINT AS score FROM c AS a JOIN c AS b USING (dim)
      WHERE a.k IN (SELECT k FROM e WHERE vec_id % {ANCHORS} = 0) GROUP BY a.k, b.k),
p AS (SELECT a.k AS ak, a.vec_id AS anchor_id, a.label, b.vec_id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY a.k ORDER BY score DESC, b.vec_id) AS place
      FROM s JOIN e AS a ON a.k = s.ak JOIN e AS b ON b.k = s.bk WHERE a.k <> b.k AND a.label = b.label),
n AS (SELECT anchor_id, positive_id, positive_score, b.vec_id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY p.ak, place ORDER BY score DESC, b.vec_id) AS rank
      FROM p JOIN s ON s.ak = p.ak JOIN e AS b ON b.k = s.bk
      WHERE place <= {POSITIVES} AND b.label <> p.label AND {LEAST} * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
