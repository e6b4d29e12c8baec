"""Operator 5, language identification by rank-order profiles.

A profile is the PROFILE most frequent letter n-grams (1 to 3 code points of lower-cased words, with word
edges) of a language over all its training texts. A text's own most frequent n-grams are ranked the same
way; the out-of-place distance adds up the differences of ranks, PROFILE for an n-gram that the profile
lacks. The nearest profile wins (ties: the first in order of names).

Counts are summed over whole texts inside tasks and then by (language, n-gram) in Spark; PROFILE rows a
language reach the driver and the tasks.

Defined results: ``und`` with score 0 for null texts and texts without a letter, and for all texts when no
training row has a language; rows with a null doc_id are never training rows; repeated rows count each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinespark.llm.common import table

PROFILE = 300
EDGE = 32
_TABLE: list[np.ndarray] = []


def held_out() -> Column:
    """Rows that no model may learn from: crc32 of the doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _letters() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _TABLE[0]


def grams(text: str) -> np.ndarray:
    """Packed n-grams of the words of a text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    s = np.full(len(codes) + 2, EDGE, np.int64)
    s[1:-1] = np.where(letter, codes, EDGE)
    keep = np.append(True, (s[1:] != EDGE) | (s[:-1] != EDGE))
    s = s[keep]
    one = s[s != EDGE]
    two = (s[:-1] << 21) | s[1:]
    three = ((s[:-2] << 42) | (s[1:-1] << 21) | s[2:])[s[1:-1] != EDGE]
    return np.concatenate([one, two, three])


def _top(values: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent values, most frequent first, ties by value."""
    found, count = np.unique(values, return_counts=True)
    return found[np.lexsort((found, -count))[:size]]


def _count(batches):
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang, parts):
        found, count = np.unique(np.concatenate(parts), return_counts=True)
        if lang in total:
            both = np.concatenate([total[lang][0], found])
            weight = np.concatenate([total[lang][1], count])
            found, where = np.unique(both, return_inverse=True)
            count = np.bincount(where, weight).astype(np.int64)
        total[lang] = found, count

    for batch in batches:
        waiting: dict[str, list] = {}
        size: dict[str, int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            g = grams(text)
            waiting.setdefault(lang, []).append(g)
            size[lang] = size.get(lang, 0) + len(g)
            if size[lang] > 1 << 21:
                add(lang, waiting.pop(lang))
                size[lang] = 0
        for lang, parts in waiting.items():
            add(lang, parts)
    for lang, (found, count) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array(found), pa.array(count)], names=["lang", "gram", "n"])


def learn_profiles(docs: DataFrame) -> dict[str, list[int]]:
    """PROFILE n-grams of every language of (lang, text) rows."""
    counted = docs.filter("lang is not null and text is not null").select("lang", "text").mapInArrow(
        _count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= PROFILE).collect()
    out: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.rank)):
        out.setdefault(r.lang, []).append(r.gram)
    return out


class Profiles:
    def __init__(self, learned: dict[str, list[int]]):
        self.langs = sorted(learned)
        self.known = np.unique(np.array([g for v in learned.values() for g in v], np.int64))
        self.rank = np.full((len(self.known) + 1, len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.rank[np.searchsorted(self.known, learned[lang]), k] = np.arange(len(learned[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and 1 - distance / greatest possible distance."""
        top = _top(grams(text)) if text else np.zeros(0, np.int64)
        if not len(top) or not self.langs:
            return "und", 0.0
        slot = np.searchsorted(self.known, top)
        slot[self.known[np.minimum(slot, len(self.known) - 1)] != top] = len(self.known)
        rank = self.rank[slot]
        away = np.where(rank < 0, PROFILE, np.abs(rank - np.arange(len(top))[:, None])).sum(0)
        best = int(np.argmin(away))
        return self.langs[best], float(1 - away[best] / (PROFILE * len(top)))


def identify(docs: DataFrame, learned: dict[str, list[int]], out: str = "language") -> DataFrame:
    """Adds ``out``: lang_pred and score."""
    if out in docs.columns:
        raise ValueError(f"the column name {out!r} is taken")
    profiles = docs.sparkSession.sparkContext.broadcast(Profiles(learned))

    def predict(column: pa.Array) -> pa.Array:
        found = [profiles.value.predict(t) for t in column.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())],
                                          names=["lang_pred", "score"])
    return docs.withColumn(out, F.arrow_udf(predict, "struct<lang_pred:string,score:double>")(F.col("text")))


def op5_rank_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = learn_profiles(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text"), learned).select(
        "doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")
