"""Operator 3, token ids as canonical length-limited Huffman code.

``write_ids`` turns each text into token ids where it is read, counts all ids of the corpus, range-sorts the
ids by doc_id, and writes two Parquet tables into a folder: ``codebook`` (id, bits), from which the canonical
code follows, and ``blocks``. A block holds whole documents of BLOCK ids together, with an end id each: the
range partition and the ids before the block in it, doc_ids, their numbers of ids, the bit stream, and the bit
offset of every LANE-th id. Blocks are decoded independently, and within a block all lanes are decoded at the
same time by table look-up. ``read_ids`` gives the ids of every document back.

The ids are written once before they are sorted; texts are never shuffled. Counts reach the driver as one row
per used id (bounded by the vocabulary), offsets as one row per range partition. Rows of one doc_id (or of
null) are spread by the hash of their ids. Task output is committed by Spark's writers, so a lost executor
repeats its tasks only.

Defined results: null texts are empty (the end id alone); null doc_ids come after all others; rows of one
doc_id stand in the order of the hash of their ids; repeated rows stay; an empty table gives an empty codebook
and no blocks; other columns are not needed.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinespark.llm.common import LAST, partitions, scratch_dir, stored, table
from cinespark.llm.packing import tokenizer_path
from cinespark.llm.tokens import encoder

END = 1
BLOCK = 1 << 16
LANE = 256
READ = 32                 # blocks decoded side by side
SPARE_BITS = 3            # longest code: this much over the bits of the number of used ids, 16 at least


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); counts are positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    packages, levels = np.zeros(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        by = np.argsort(both, kind="stable")
        levels.append(by)
        both = both[by]
        half = len(both) // 2
        packages = both[0:2 * half:2] + both[1:2 * half:2]
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for by in reversed(levels):                                       # which coins the first ``take`` items hold
        chosen = by[:take]
        singles = chosen[chosen < n]
        lengths[singles] += 1
        take = 2 * (len(chosen) - len(singles))
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code of (ids, bits): shorter first, then by id."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        order = np.lexsort((ids, bits))
        self.ids, self.bits = ids[order].astype(np.int64), bits[order].astype(np.int64)
        self.longest = int(self.bits.max()) if len(ids) else 1
        span = np.left_shift(np.int64(1), self.longest - self.bits)
        first = np.cumsum(span) - span
        self.codes = (first >> (self.longest - self.bits)).astype(np.uint64)
        size = int(self.ids.max()) + 1 if len(ids) else 1
        self.code_of, self.bits_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.ids], self.bits_of[self.ids] = self.codes, self.bits
        self.table_id, self.table_bits = np.repeat(self.ids, span).astype(np.uint32), np.repeat(self.bits, span)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bit stream (most significant bit first, in 64-bit words) and the offset of every LANE-th id."""
        bits, code = self.bits_of[ids], self.code_of[ids]
        ends = np.cumsum(bits)
        offset = ends - bits
        words = np.zeros(int(ends[-1] >> 6) + 2 if len(ids) else 1, np.uint64)
        if len(ids):
            word, room = offset >> 6, 64 - (offset & 63)
            over = bits - room
            fits = over <= 0
            here = np.where(fits, code << np.where(fits, -over, 0).astype(np.uint64), code >> np.where(fits, 0, over).astype(np.uint64))
            head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            words[word[head]] = np.add.reduceat(here, head)
            split = np.flatnonzero(~fits)
            words[word[split] + 1] |= code[split] << (64 - over[split]).astype(np.uint64)
        return words.astype(">u8").tobytes(), offset[::LANE]

    def decode(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """Ids of blocks (bit stream, offsets of lanes, number of ids), all lanes side by side."""
        if not blocks:
            return []
        words = np.concatenate([np.frombuffer(b, ">u8").astype(np.uint64) for b, _, _ in blocks] + [np.zeros(2, np.uint64)])
        base = np.cumsum([0] + [len(b) // 8 for b, _, _ in blocks])
        first = np.cumsum([0] + [n for _, _, n in blocks])
        at = np.concatenate([o.astype(np.int64) + 64 * w for (_, o, _), w in zip(blocks, base)])
        to = np.concatenate([f + LANE * np.arange(len(o)) for (_, o, _), f in zip(blocks, first)])
        count = np.concatenate([np.minimum(LANE, n - LANE * np.arange(len(o))) for _, o, n in blocks])
        order = np.argsort(-count, kind="stable")
        at, to, count = at[order], to[order], count[order]
        out = np.zeros(int(first[-1]), np.uint32)
        left = np.uint64(64 - self.longest)
        for step in range(int(count.max()) if len(count) else 0):
            live = int(np.searchsorted(-count, -step, "left"))       # lanes with more than ``step`` ids
            a = at[:live]
            w, s = a >> 6, (a & 63).astype(np.uint64)
            bits = (words[w] << s) | ((words[w + 1] >> np.uint64(1)) >> (np.uint64(63) - s))
            slot = bits >> left
            out[to[:live] + step] = self.table_id[slot]
            at[:live] += self.table_bits[slot]
        return [out[x:y] for x, y in zip(first[:-1], first[1:])]


def _tokenize(path: str):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for first, blobs in enc.encode_rows(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(blobs)), blobs], names=["ord", "ids"])
    return run


def _count(width: str, size: int):
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), width)
            total += np.bincount(ids, minlength=size)
            total[END] += batch.num_rows
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "count"])
    return run


def _encode(width: str, book):
    def block(rows, part, start):
        ids = [np.append(np.frombuffer(r, width), np.array([END], width)) for _, r in rows]
        stream, lanes = book.value.encode(np.concatenate(ids))
        return (part, start, np.array([o for o, _ in rows], "<i8").tobytes(), np.array([len(i) for i in ids], "<i8").tobytes(),
                stream, lanes.astype("<i8").tobytes()), sum(map(len, ids))

    def batch_of(rows):
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(6)], names=[
            "part", "start", "docs", "sizes", "stream", "lanes"])

    def run(batches):
        part, start, rows, size = TaskContext.get().partitionId(), 0, [], 0
        item = np.dtype(width).itemsize
        for batch in batches:
            out = []
            for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows.append(r)
                size += len(r[1]) // item + 1
                if size >= BLOCK:
                    made, n = block(rows, part, start)
                    out.append(made)
                    start, rows, size = start + n, [], 0
            if out:
                yield batch_of(out)
        if rows:
            yield batch_of([block(rows, part, start)[0]])
    return run


def write_ids(docs: DataFrame, path: str, out: str) -> None:
    """Writes the coded ids of all texts, in ascending doc_id order, as Parquet tables in the folder ``out``."""
    spark = docs.sparkSession
    enc = encoder(path)
    width = enc.dtype.str
    tokens = stored(docs.select(F.coalesce("doc_id", F.lit(LAST)).cast("long").alias("ord"), "text").mapInArrow(
        _tokenize(path), "ord long, ids binary").withColumn("digest", F.xxhash64("ids")))
    counts = np.array([tuple(r) for r in tokens.select("ids").mapInArrow(_count(width, max(enc.size, END + 1)), "id long, count long")
                       .groupBy("id").agg(F.sum("count")).collect()], np.int64).reshape(-1, 2)
    limit = max(16, int(len(counts)).bit_length() + SPARE_BITS)
    code = Code(counts[:, 0], code_lengths(counts[:, 1], limit))
    spark.createDataFrame(list(zip(code.ids.tolist(), code.bits.tolist())), "id long, bits long").coalesce(1).write.parquet(f"{out}/codebook")
    ordered = tokens.repartitionByRange(partitions(spark), "ord", "digest").sortWithinPartitions("ord", "digest").select("ord", "ids")
    (ordered.mapInArrow(_encode(width, spark.sparkContext.broadcast(code)),
                        "part int, start long, docs binary, sizes binary, stream binary, lanes binary")
     .write.option("compression", "none").parquet(f"{out}/blocks"))


def _decode(book, base, emit):
    def run(batches):
        for batch in (b.slice(k, READ) for b in batches for k in range(0, b.num_rows, READ)):
            starts, docs, sizes, streams, lanes = (batch.column(c).to_pylist() for c in ("start", "docs", "sizes", "stream", "lanes"))
            starts = [x + base.value[part] for x, part in zip(starts, batch.column("part").to_pylist())]
            sizes = [np.frombuffer(s, "<i8") for s in sizes]
            blocks = [(s, np.frombuffer(x, "<i8"), int(n.sum())) for s, x, n in zip(streams, lanes, sizes)]
            ids = book.value.decode(blocks)
            out = [], [], [], []
            for start, d, n, i in zip(starts, docs, sizes, ids):
                ends = np.cumsum(n)
                out[0].extend(np.frombuffer(d, "<i8").tolist())
                out[1].extend((start + ends - n).tolist())
                out[2].extend(n.tolist())
                raw = i.astype("<u4").tobytes()
                out[3].extend(emit(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), n.tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([x if x != LAST else None for x in out[0]], pa.int64()),
                                              *(pa.array(x, pa.int64()) for x in out[1:3]), pa.array(out[3])],
                                             names=["doc_id", "start", "n_tokens", "ids"])
    return run


def _read(spark: SparkSession, out: str, emit, kind: str) -> DataFrame:
    rows = np.array([tuple(r) for r in spark.read.parquet(f"{out}/codebook").collect()], np.int64).reshape(-1, 2)
    book = spark.sparkContext.broadcast(Code(rows[:, 0], rows[:, 1]))
    blocks, base, before = spark.read.parquet(f"{out}/blocks"), {}, 0
    ends = blocks.groupBy("part").agg(F.max_by("sizes", "start"), F.max("start")).collect()
    for part, sizes, start in sorted(map(tuple, ends)):              # the last block of each range partition
        base[part], before = before, before + start + int(np.frombuffer(sizes, "<i8").sum())
    base = spark.sparkContext.broadcast(base)
    return blocks.mapInArrow(_decode(book, base, emit), f"doc_id long, start long, n_tokens long, ids {kind}")


def read_ids(spark: SparkSession, out: str) -> DataFrame:
    """One row per document: doc_id, start (ids before it), n_tokens, ids (32-bit little-endian)."""
    return _read(spark, out, bytes, "binary")


def op3_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark)
    write_ids(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), out)
    return _read(spark, out, zlib.crc32, "long").withColumnRenamed("ids", "ids_crc32")
