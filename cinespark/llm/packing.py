"""Operator 9, packing along a space-filling curve.

Every document becomes a point: its token ids are hashed to signs in DIMS dimensions and summed, scaled by
the root of the length and squeezed to BITS bits a dimension. Documents are range-sorted by the Hilbert key
of their point (ties by row), laid end to end along the curve and cut every LENGTH tokens, so a sequence
holds neighbours on the curve and only the last one is padded.

The ids are written once; the sort moves only (row, key, length). Equal keys, such as those of a third of
all documents, are spread by the row number that is part of the sort key. Offsets of the range partitions
are one number a partition.

Defined results: a null text is empty and has the end id alone; repeated rows are packed each; null doc_ids
stay null; other columns are not needed.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinespark.llm.common import mix, partitions, stored, table
from cinespark.llm.tokens import encoder

LENGTH = 2048
END = 1
DIMS, BITS = 4, 12


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points (rows): Gray-code descent from the top bit, vectorised.

    The state of a cell is the entry corner and the direction of its sub-curve."""
    n, dims = points.shape
    index = np.zeros(n, np.uint64)
    entry = np.zeros(n, np.int64)
    turn = np.zeros(n, np.int64)
    mask = (1 << dims) - 1

    def rotate(x, k):                                                # to the right by k of dims bits
        return ((x >> k) | (x << (dims - k))) & mask

    for b in range(bits - 1, -1, -1):
        corner = np.zeros(n, np.int64)
        for d in range(dims):
            corner |= ((points[:, d] >> b) & 1).astype(np.int64) << d
        gray = rotate(corner ^ entry, turn + 1 - dims * (turn + 1 >= dims))
        rank = gray.copy()                                           # inverse of the Gray code
        shift = 1
        while shift < dims:
            rank ^= rank >> shift
            shift <<= 1
        index = (index << np.uint64(dims)) | rank.astype(np.uint64)
        low = np.where(rank > 0, (rank - 1) & ~1, 0)
        first = low ^ (low >> 1)                                     # entry of the sub-cell of this rank
        k = turn + 1 - dims * (turn + 1 >= dims)
        entry ^= rotate(first, (dims - k) % dims)
        odd = np.where(rank & 1, rank, np.maximum(rank - 1, 0))      # trailing set bits give the direction
        ones = np.zeros(n, np.int64)
        run = np.ones(n, bool)
        for d in range(dims):
            run &= ((odd >> d) & 1).astype(bool)
            ones += run
        turn = (turn + np.where(rank > 0, ones, 0) + 1) % dims
    return index


_SIGNS: dict[int, np.ndarray] = {}
#: The signs that a number of DIMS bits stands for.
_CORNERS = (np.arange(1 << DIMS)[:, None] >> np.arange(DIMS) & 1) * 2 - 1


def _signs(size: int) -> np.ndarray:
    """The hashed signs of each id, as bits."""
    if size not in _SIGNS:
        with np.errstate(over="ignore"):
            h = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _SIGNS[size] = (h & np.uint64((1 << DIMS) - 1)).astype(np.uint8)
    return _SIGNS[size]


def curve_keys(ids: list[np.ndarray], size: int) -> np.ndarray:
    """Hilbert keys of documents, from their ids."""
    signs = _signs(size)
    points = np.array([np.bincount(signs[i], minlength=1 << DIMS) @ _CORNERS / np.sqrt(max(len(i), 1)) for i in ids], np.float64).reshape(-1, DIMS)
    cells = ((1 + np.tanh(points / 4)) / 2 * (1 << BITS)).astype(np.int64)
    return hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS).astype(np.int64)


def _tokenize(path: str):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for first, blobs in enc.encode_rows(batch.column(1)):
                ids = [np.frombuffer(b, enc.dtype) for b in blobs.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(ids)), pa.array([len(i) + 1 for i in ids], pa.int64()),
                     pa.array(curve_keys(ids, enc.size)), blobs], names=["doc_id", "n", "key", "ids"])
    return run


def _cut(width: str, length: int):
    def run(batches):
        for batch in batches:
            doc, n, pos, blobs = (batch.column(c).to_pylist() for c in range(4))
            rows = []
            for d, size, at, blob in zip(doc, n, pos, blobs):
                raw = np.append(np.frombuffer(blob, width).astype("<u4"), np.uint32(END)).tobytes()
                a = 0
                while a < size:
                    b = min(size, (at + a) // length * length + length - at)
                    rows.append((d, a, b - a, zlib.crc32(raw[4 * a:4 * b]), size, (at + a) // length, (at + a) % length))
                    a = b
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 7, names=[
                "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    width = np.dtype(encoder(path).dtype).str
    tokens = docs.select("doc_id", "text").mapInArrow(_tokenize(path), "doc_id long, n long, key long, ids binary")
    tokens = stored(tokens.withColumn("row", F.monotonically_increasing_id()))
    placed = stored(tokens.select("row", "key", "n").repartitionByRange(partitions(spark), "key", "row")
                    .withColumn("part", F.spark_partition_id()))
    before, sizes = 0, []
    for part, n in sorted(placed.groupBy("part").agg(F.sum("n")).collect()):     # one number a partition
        sizes.append((part, before))
        before += n
    starts = spark.createDataFrame(sizes, "part int, base long")
    inside = Window.partitionBy("part").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, -1)
    places = placed.withColumn("at", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(starts), "part").select(
        "row", (F.col("base") + F.col("at")).alias("pos"))
    return tokens.join(places, "row").select("doc_id", "n", "pos", "ids").mapInArrow(
        _cut(width, length), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op9_hilbert_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
