"""Operator 7, n-gram Jaccard join with Bayesian pruning of candidates.

Documents with equal sets of SHINGLE-word shingles form one class (words are what stands between white
space, lower-cased). Classes that share one of BANDS bands of ROWS MinHash values are candidates; at the
threshold 0.8 a pair shares none with probability (1 - 0.8 ** 4) ** 32 = 5e-8. A candidate's MinHash values
are then compared STEP by STEP, and a pair goes as soon as the posterior probability that its similarity
reaches the threshold (uniform prior) is below TOLERANCE. Pairs left over connect classes to candidate
components, inside which every pair is verified exactly on the whole shingle sets.

No pairs are written. A bucket of one band is split into blocks of BLOCK classes and handled block by
block; a task compares all of them with its first class and the classes that are not like it with all, and
gives the edges of a spanning forest. A component is verified block by block too, by counting common
shingles, and gives each class its number of links and a spanning forest of the links. Rows are replicated
once for each block pair, so no task holds more than two blocks of one group.

Defined results: a text of one to four words has one shingle; texts without a word form one class without
links; null doc_ids stand as one id after all others; repeated rows each get the row of their class.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinespark.llm.common import (LAST, LOWER, SOLID, free_name, joined, mix, partitions, shards, span_hashes, stored, table, utf8_list,
                                  word_spans)
from cinespark.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS, STEP = 32, 4, 32
HASHES = BANDS * ROWS
TOLERANCE = 1e-6
BLOCK = 2048

_rng = np.random.default_rng(20240501)
_MUL = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(texts: list[bytes], n: int = SHINGLE):
    """Sorted distinct shingle hashes of each text."""
    for a, b in shards(texts, 1 << 20):
        buf, offsets = joined(texts[a:b])
        low = LOWER[buf]
        starts, ends = word_spans(low, SOLID)
        words = span_hashes(low, starts, ends)
        doc = np.searchsorted(offsets, starts, "right") - 1
        first = np.searchsorted(doc, np.arange(b - a + 1))
        with np.errstate(over="ignore"):
            h = np.zeros(len(words), np.uint64)
            for j in range(n):
                factor = np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64))
                h[:len(words) - j] += words[j:] * factor
            h = mix(h)
            for i in range(b - a):
                x, y = int(first[i]), int(first[i + 1])
                if y - x >= n:
                    yield np.unique(h[x:y - n + 1])
                elif y > x:
                    factors = np.array([pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j in range(y - x)], np.uint64)
                    yield mix(np.array([(words[x:y] * factors).sum() + np.uint64(y - x)], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes()).digest()


def minhash(shingles: np.ndarray) -> np.ndarray:
    """HASHES least values of the set, 32 bits each."""
    low = np.full(HASHES, np.uint64(0xFFFFFFFFFFFFFFFF))
    with np.errstate(over="ignore"):
        for x in range(0, len(shingles), 2048):
            np.minimum(low, (shingles[x:x + 2048, None] * _MUL + _ADD).min(0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def _signatures(batches):
    for batch in batches:
        keys, sizes, sigs, bands = [], [], [], []
        texts = utf8_list(batch.column(1))
        for s in shingle_sets(texts):
            m = minhash(s)
            keys.append(set_key(s))
            sizes.append(len(s))
            sigs.append(m.astype(np.uint8).tobytes())                # the last byte of each value is compared
            bands.append(m.tobytes())
        m = np.frombuffer(b"".join(bands), np.uint32).reshape(-1, BANDS, ROWS)
        with np.errstate(over="ignore"):
            h = mix(((m[:, :, 0].astype(np.uint64) << np.uint64(32)) | m[:, :, 1])
                    + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            h = mix(h ^ ((m[:, :, 2].astype(np.uint64) << np.uint64(32)) | m[:, :, 3])).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()),
             pa.ListArray.from_arrays(np.arange(0, BANDS * len(keys) + 1, BANDS, dtype=np.int32), pa.array(h.ravel()))],
            names=["ord", "digest", "cls", "n", "sig", "bands"])


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For STEP, 2 STEP, ... compared values: the fewest matches whose posterior P(similarity >= threshold) is not below tolerance."""
    s = np.linspace(0, 1, 200_001)[1:-1]
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(s) + (n - m) * np.log1p(-s)
            p = np.exp(log - log.max())
            if p[s >= threshold].sum() >= tolerance * p.sum():
                out.append(m)
                break
    return out


def alike(sigs: np.ndarray, other: np.ndarray, least: list[int]) -> np.ndarray:
    """Which rows of ``sigs`` are not pruned against the signature ``other``, comparing STEP values at a time."""
    left = np.arange(len(sigs))
    found = np.zeros(len(sigs), np.int64)
    for k, need in enumerate(least):
        part = slice(k * STEP, (k + 1) * STEP)
        found = found + (sigs[left, part] == other[part]).sum(1)
        keep = found >= need
        left, found = left[keep], found[keep]
    return left


def _roots(n: int, links) -> np.ndarray:
    """Least member of each one's connected set; links: (i, array of others)."""
    root = np.arange(n)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, others in links:
        for j in np.atleast_1d(others).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)])


def _reached(link: np.ndarray) -> np.ndarray:
    """Least member of each one's connected set; link: symmetric matrix."""
    root = np.full(len(link), -1)
    for i in range(len(link)):
        if root[i] < 0:
            root[i], front = i, np.array([i])
            while len(front):
                front = np.flatnonzero(link[front].any(0) & (root < 0))
                root[front] = i
    return root


def _bucket_edges(least: list[int]):
    def edges(key, rows):
        rows = rows.sort_by([("band", "ascending"), ("i", "ascending"), ("j", "ascending"), ("cls", "ascending")])
        group = np.stack([rows.column(c).to_numpy() for c in ("band", "i", "j")], 1)
        cls = rows.column("cls").to_pylist()
        sigs = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
        cuts = np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1
        out = set()
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cls)]):
            if y - x < 2:
                continue
            own = sigs[x:y]
            like = alike(own, own[0], least)
            links = [(0, like)]
            rest = np.setdiff1d(np.arange(y - x), like, assume_unique=True)
            links += [(int(i), alike(own, own[i], least)) for i in rest]
            for i, r in enumerate(_roots(y - x, links).tolist()):
                if i != r:
                    out.add((cls[x + i], cls[x + r]))
        out = sorted(out)
        return pa.table({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())})
    return edges


def _blocked(df: DataFrame, group: str, block: int) -> DataFrame:
    """Replicates each row of (group, cls, size) for the pairs of blocks (i <= j) that its block is in."""
    blocks = F.ceil(F.col("size") / F.lit(block))
    own = F.pmod(F.xxhash64("cls", F.lit(7)), blocks)
    return (df.withColumn("own", own.cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
            .withColumn("i", F.least("own", "with")).withColumn("j", F.greatest("own", "with")).drop("with"))


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections."""
    n = len(sets)
    size = np.fromiter(map(len, sets), np.int64, n)
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    by = np.argsort(value, kind="stable")
    value, owner = value[by], owner[by]
    head = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    count = np.diff(np.append(head, len(value)))
    head, count = head[count > 1], count[count > 1]
    common = np.zeros((n, n), np.int32)                              # one matrix and one addend at a time
    many = (count.astype(np.float64) ** 2 * 16 > float(n) * n) & (n >= 16)
    rare, few = head[~many], count[~many]
    for c in np.unique(few).tolist():                                # few have it: count their pairs
        x, y = np.triu_indices(c, 1)
        rows = rare[few == c]
        step = max(1, (1 << 20) // len(x))
        for k in range(0, len(rows), step):
            o = owner[rows[k:k + step, None] + np.arange(c)]
            np.add.at(common, (o[:, x].ravel(), o[:, y].ravel()), 1)
    common += common.T.copy()
    head, count = head[many], count[many]
    for k in range(0, len(head), 2048):                              # many have it: products of incidence rows
        h, c = head[k:k + 2048], count[k:k + 2048]
        col = np.repeat(np.arange(len(h)), c)
        at = np.repeat(h - (np.cumsum(c) - c), c) + np.arange(c.sum())
        m = np.zeros((n, len(h)), np.float32)
        m[owner[at], col] = 1
        np.add(common, m @ m.T, out=common, casting="unsafe")
    np.fill_diagonal(common, size)
    return common


def _verify(threshold: float):
    def verify(key, rows):
        rows = rows.sort_by([("root", "ascending"), ("i", "ascending"), ("j", "ascending"), ("cls", "ascending")])
        root, cls = rows.column("root").to_pylist(), rows.column("cls").to_pylist()
        i, j, own = (rows.column(c).to_numpy() for c in ("i", "j", "own"))
        many = (rows.column("size").to_numpy() > BLOCK)
        blobs = rows.column("shingles").to_pylist()
        cuts = [k for k in range(1, len(cls)) if root[k] != root[k - 1] or i[k] != i[k - 1] or j[k] != j[k - 1]]
        out = {"cls": [], "links": [], "other": [], "many": []}
        for x, y in zip([0, *cuts], [*cuts, len(cls)]) if cls else ():
            sets = [np.frombuffer(b, np.uint64) for b in blobs[x:y]]
            size = np.fromiter(map(len, sets), np.int64, y - x)
            common = common_counts(sets)
            across = np.empty(common.shape, bool)
            for k in range(0, y - x, 256):
                part = common[k:k + 256]
                across[k:k + 256] = part >= threshold * (size[k:k + 256, None] + size[None, :] - part) - 1e-9
            np.fill_diagonal(across, False)
            if i[x] != j[x]:
                across &= own[x:y, None] != own[None, x:y]           # each pair in one task
            roots = _reached(across)
            out["cls"] += cls[x:y]
            out["links"] += across.sum(1).tolist()
            out["other"] += [cls[x + r] for r in roots.tolist()]
            out["many"] += many[x:y].tolist()
        return pa.table({"cls": pa.array(out["cls"], pa.binary()), "links": pa.array(out["links"], pa.int64()),
                         "other": pa.array(out["other"], pa.binary()), "many": pa.array(out["many"], pa.bool_())})
    return verify


def _sets(batches):
    for batch in batches:
        sets = list(shingle_sets(utf8_list(batch.column(0))))
        yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()),
                                          pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "shingles"])


def _classes(docs: DataFrame, threshold: float, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Rows (ord, digest of the text, cls) of the documents, and a row for each shingle set: cls, first (its least ord), n_links, root (one
    value for all sets that links lead to), class_first (the least ord of these)."""
    spark = docs.sparkSession
    buckets = 4 * partitions(spark)
    keyed = docs.select(F.coalesce("doc_id", F.lit(LAST)).cast("long").alias("ord"), "text")
    signed = stored(keyed.mapInArrow(_signatures, "ord long, digest binary, cls binary, n long, sig binary, bands array<long>"))
    sets = signed.groupBy("cls").agg(F.min("ord").alias("first"), F.first("n").alias("n"),
                                     F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    sets = stored(sets)
    banded = sets.filter("n > 0").select("cls", F.explode("bands").alias("band"))
    full = banded.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    rows = _blocked(banded.join(full, "band"), "band", BLOCK).join(sets.select("cls", "sig"), "cls")
    rows = rows.select("band", "i", "j", "cls", "sig", F.pmod(F.xxhash64("band", "i", "j"), F.lit(buckets)).alias("bucket"))
    pairs = rows.groupBy("bucket").applyInArrow(_bucket_edges(least_matches(threshold, tolerance)), "a binary, b binary")
    candidates = components(pairs).select(F.col("node").alias("cls"), "root")
    sized = candidates.join(candidates.groupBy("root").agg(F.count("*").alias("size")), "root")
    wanted = candidates.join(sets.select("cls", F.col("first").alias("ord")), "cls").select("ord")
    texts = keyed.join(wanted, "ord", "left_semi").select("text")
    shingles = texts.mapInArrow(_sets, "cls binary, shingles binary").dropDuplicates(["cls"])
    work = _blocked(sized, "root", BLOCK).join(shingles, "cls").select(
        "root", "i", "j", "own", "size", "cls", "shingles", F.pmod(F.xxhash64("root", "i", "j"), F.lit(buckets)).alias("bucket"))
    verified = stored(work.groupBy("bucket").applyInArrow(_verify(threshold), "cls binary, links long, other binary, many boolean"))
    links = verified.groupBy("cls").agg(F.sum("links").alias("n_links"))
    roots = verified.filter("not many").select("cls", F.col("other").alias("root"))
    if verified.filter("many").limit(1).count():
        large = verified.filter("many")
        linked = components(large.select(F.col("cls").alias("a"), F.col("other").alias("b")))
        roots = roots.union(large.select("cls").distinct().join(
            linked.withColumnRenamed("node", "cls"), "cls", "left").select("cls", F.coalesce("root", "cls")))
    named = (sets.select("cls", "first").join(links.filter("n_links > 0"), "cls", "left").join(roots, "cls", "left")
             .select("cls", "first", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "cls").alias("root")))
    least = named.filter("n_links > 0").groupBy("root").agg(F.min("first").alias("class_first"))
    named = named.join(least, "root", "left").select("cls", "first", "n_links", "root", F.coalesce("class_first", "first").alias("class_first"))
    return signed.select("ord", "digest", "cls"), named


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, set_id (least doc_id with an equal shingle set), class_id (least doc_id of all
    that links lead to), n_links (other shingle sets whose similarity reaches the threshold)."""
    signed, named = _classes(docs, threshold, tolerance)
    null_last = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return signed.select("ord", "cls").join(named, "cls").select(
        null_last("ord").alias("doc_id"), null_last("first").alias("set_id"), null_last("class_first").alias("class_id"), "n_links")


def op7_bayes_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class: the one with the least (doc_id, text digest), null doc_ids after all others; of rows
    that repeat both one stays. Texts without a word are one class."""
    signed, named = _classes(docs, THRESHOLD, TOLERANCE)
    # the least row of each shingle set, then of each class; narrow rows only
    least = signed.groupBy("cls").agg(F.min(F.struct("ord", "digest")).alias("least"))
    kept = least.join(named.select("cls", "root"), "cls").groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.ord").alias("ord"), F.col("least.digest").alias("digest"))
    kept = stored(kept)
    key = F.struct(F.coalesce("doc_id", F.lit(LAST)).cast("long").alias("ord"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))
    name = free_name("kept", docs.columns)
    one = docs.withColumn(name, key)
    return (one.join(kept.select(F.struct("ord", "digest").alias(name)), name, "left_semi")
            .dropDuplicates([name]).select([f"`{c}`" for c in docs.columns]))
