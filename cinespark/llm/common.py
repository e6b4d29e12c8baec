"""Helpers shared by the operators: inputs, scratch tables, byte-level word hashing."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Order of rows whose doc_id is null: after all others, equal among themselves.
LAST = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new path under ``spark.checkpoint.dir``; a folder of its own only on a local master that has none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="cinespark-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write once as Parquet in the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(name: str, columns) -> str:
    """``name``, with _ in front until no column has it (in either case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shards(texts, limit: int = 4 << 20):
    """(first, end) ranges of consecutive texts holding about ``limit`` bytes; a longer text stands alone."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def utf8_list(column: pa.Array) -> list[bytes]:
    """Whole texts of an Arrow string column as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


# -- words as 64-bit hashes, vectorised over a buffer of UTF-8 bytes ---------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    have = 1
    step = base
    while have < n:
        take = min(have, n - have)
        out[have:have + take] = out[:take] * step
        have += take
        step = step * step
    return out[:n]


class _Powers:
    """Grown on demand and kept by the worker process."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int):
        if len(cls.up) < n:
            with np.errstate(over="ignore"):
                cls.up, cls.down = powers(n, _BASE), powers(n, _INV)
        return cls.up[:n], cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (public domain murmur constants)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


#: Bytes of words: digits, lower-case letters, all of non-ASCII. A-Z count once lowered.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes of whitespace-separated words: all but blank and \t..\r.
SOLID = np.ones(256, bool)
SOLID[32] = False
SOLID[9:14] = False


def word_spans(buf: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes for which ``kind`` holds."""
    flags = np.empty(len(buf) + 2, np.int8)
    flags[0] = flags[-1] = 0
    flags[1:-1] = kind[buf]
    edges = np.flatnonzero(flags[1:] != flags[:-1])
    return edges[::2], edges[1::2]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each buf[start:end]: prefix sums of a polynomial, shifted back to the start."""
    with np.errstate(over="ignore"):
        up, down = _Powers.of(len(buf) + 1)
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:len(buf)], out=total[1:])
        h = (total[ends] - total[starts]) * down[starts]
        return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with \\n after each text, and the offset of each text (one more than the texts)."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), offsets


def key_order(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """Adds ``ord``: doc_id, null after all others."""
    return df.withColumn("ord", F.coalesce(F.col(name), F.lit(LAST)))
