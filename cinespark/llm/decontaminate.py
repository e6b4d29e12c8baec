"""Operator 4, benchmark decontamination: suffix arrays of the training text, searched by every test suffix.

Each batch of documents is cut into shards of a few MB. A shard's words become ids of the benchmark's
vocabulary (0: no such word), and a suffix array orders every word position from which a whole window
can still match, by its next WINDOW ids. Every test suffix is then found by binary search; hits on one
diagonal join into the longest verbatim match, reported with its places in item and document. The
word bytes of every hit are compared, so hash collisions give no hit.

Documents are never shuffled. The benchmark comes in blocks of at most BLOCK_BYTES on average (by the
hash of item_id), each broadcast alone; from the second block on, the result so far is a stored table.

Defined results: null or empty texts have no words; items without words or with a null id match
nothing; repeated items count once by id; repeated documents are searched one by one; other columns
are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinespark.llm.common import ALNUM, LOWER, joined, shards, span_hashes, stored, table, utf8_list, word_spans

WINDOW = 10
BLOCK_BYTES = 32 << 20
RESULT = ("struct<n_words:bigint,n_hit:bigint,"
          "matches:array<struct<item_id:bigint,item_word:int,doc_word:int,n_words:int>>>")


class TestSet:
    """Vocabulary and windows of one block of items."""

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW):
        self.window = window
        items = sorted({(i, t or "") for i, t in items if i is not None})
        buf, offsets = joined([t.encode("utf-8", "replace") for _, t in items])
        low = LOWER[buf]
        starts, ends = word_spans(low, ALNUM)
        hashes = span_hashes(low, starts, ends)
        self.vocab, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
        self.words = [low[starts[i]:ends[i]].tobytes() for i in first]
        if any(low[s:e].tobytes() != self.words[k] for s, e, k in zip(starts, ends, ids)):
            raise ValueError("two words of the benchmark share a hash")
        item = np.searchsorted(offsets, starts, "right") - 1
        n_words = np.bincount(item, minlength=len(items))
        first_word = np.concatenate([[0], np.cumsum(n_words)])
        place = np.arange(len(starts)) - first_word[item] if len(starts) else np.zeros(0, np.int64)
        size = np.minimum(n_words[item], window) if len(starts) else np.zeros(0, np.int64)
        ok = place + size <= n_words[item] if len(starts) else np.zeros(0, bool)
        at = np.flatnonzero(ok)
        self.item = np.array([items[k][0] for k in item[at]], np.int64)
        self.order = item[at]
        self.place, self.size = place[at], size[at]
        self.least = int(self.size.min()) if len(at) else window
        low_ids = np.zeros((len(at), window), np.uint32)
        for j in range(window):
            inside = j < self.size
            low_ids[inside, j] = ids[at[inside] + j] + 1
        high_ids = low_ids.copy()
        high_ids[low_ids == 0] = 0xFFFFFFFF
        self.lo, self.hi = self._keys(low_ids), self._keys(high_ids)

    def _keys(self, ids: np.ndarray) -> np.ndarray:
        """Rows of ids as byte strings in the order of the ids."""
        return np.ascontiguousarray(ids.astype(">u4")).view(f"S{4 * self.window}").ravel()

    def search(self, texts: list[bytes]):
        """n_words and n_hit per text, and the matches (text, item, item word, text word, words)."""
        none = np.zeros((0, 5), np.int64)
        buf, offsets = joined(texts)
        low = LOWER[buf]
        starts, ends = word_spans(low, ALNUM)
        doc = np.searchsorted(offsets, starts, "right") - 1
        n_words = np.bincount(doc, minlength=len(texts))
        if not len(starts) or not len(self.vocab):
            return n_words, np.zeros(len(texts), np.int64), none
        hashes = span_hashes(low, starts, ends)
        slot = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        ids = np.where(self.vocab[slot] == hashes, slot + 1, 0).astype(np.uint32)
        first_word = np.concatenate([[0], np.cumsum(n_words)])
        stops = np.union1d(np.flatnonzero(ids == 0), first_word)
        known = np.flatnonzero(ids)
        room = stops[np.searchsorted(stops, known, "right")] - known
        at = known[room >= self.least]
        room = room[room >= self.least]
        if not len(at):
            return n_words, np.zeros(len(texts), np.int64), none
        prefix = np.zeros((len(at), self.window), np.uint32)
        for j in range(self.window):
            inside = j < room
            prefix[inside, j] = ids[at[inside] + j]
        keys = self._keys(prefix)
        suffixes = np.argsort(keys, kind="stable")                 # the shard's suffix array
        keys, at = keys[suffixes], at[suffixes]
        lo, hi = np.searchsorted(keys, self.lo, "left"), np.searchsorted(keys, self.hi, "right")
        count = hi - lo
        test = np.repeat(np.arange(len(lo)), count)
        pos = at[np.repeat(lo, count) + np.arange(len(test)) - np.repeat(np.cumsum(count) - count, count)]
        if len(pos):
            size = self.size[test]
            sure = np.ones(len(starts), bool)
            touched = np.unique(np.concatenate([pos[size > j] + j for j in range(self.window)]))
            for p in touched.tolist():
                sure[p] = low[starts[p]:ends[p]].tobytes() == self.words[ids[p] - 1]
            wrong = np.concatenate([[0], np.cumsum(~sure)])
            right = wrong[pos + size] == wrong[pos]
            test, pos = test[right], pos[right]
        if not len(pos):
            return n_words, np.zeros(len(texts), np.int64), none
        size, place, order = self.size[test], self.place[test], self.order[test]
        marks = np.zeros(len(starts) + 1, np.int64)
        np.add.at(marks, pos, 1)
        np.add.at(marks, pos + size, -1)
        hit = np.cumsum(marks[:-1]) > 0
        n_hit = np.bincount(doc[hit], minlength=len(texts))
        by = np.lexsort((pos, pos - place, order))                 # diagonals of an item
        pos, place, order, size, test = pos[by], place[by], order[by], size[by], test[by]
        new = np.ones(len(pos), bool)
        new[1:] = ((pos[1:] != pos[:-1] + 1) | (place[1:] != place[:-1] + 1) | (order[1:] != order[:-1])
                   | (doc[pos[1:]] != doc[pos[:-1]]))
        head = np.flatnonzero(new)
        length = np.diff(np.append(head, len(pos))) - 1 + size[head]
        d = doc[pos[head]]
        return n_words, n_hit, np.stack([d, self.item[test[head]], place[head], pos[head] - first_word[d], length], 1)


def _search(block):
    def leak(column: pa.Array) -> pa.Array:
        test, texts = block.value, utf8_list(column)
        n_words, n_hit, found = [], [], []
        for a, b in shards(texts):
            w, h, m = test.search(texts[a:b])
            m = m.copy()
            m[:, 0] += a
            n_words.append(w), n_hit.append(h), found.append(m)
        m = np.concatenate([*found, np.zeros((0, 5), np.int64)])
        m = m[np.lexsort((m[:, 2], m[:, 3], m[:, 1], m[:, 0]))]
        offsets = np.searchsorted(m[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
        parts = pa.StructArray.from_arrays(
            [pa.array(m[:, 1]), *(pa.array(m[:, k].astype(np.int32)) for k in (2, 3, 4))],
            names=["item_id", "item_word", "doc_word", "n_words"])
        flat = lambda x: pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64))
        return pa.StructArray.from_arrays(
            [flat(n_words), flat(n_hit), pa.ListArray.from_arrays(pa.array(offsets), parts)],
            names=["n_words", "n_hit", "matches"])
    return F.arrow_udf(leak, RESULT)


def _hit_words(matches):
    """Words in the union of the matches, from the merged matches of several blocks."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(
        m["doc_word"].alias("a"), (m["doc_word"] + m["n_words"]).alias("b"))))
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(F.greatest(acc["end"], s["b"]).alias("end"),
                                (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(acc["end"], s["a"]))).alias("n")),
        lambda acc: acc["n"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, out: str = "leak", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds ``out``: n_words, n_hit and the longest verbatim matches of benchmark items in each document."""
    if out in docs.columns:
        raise ValueError(f"the column name {out!r} is taken")
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()
        test = spark.sparkContext.broadcast(TestSet([(r.item_id, r.text) for r in rows]))
        found = _search(test)(F.col("text"))
        if k == 0:
            docs = docs.withColumn(out, found)
            continue
        docs = stored(docs).withColumn(f"{out}_next", found)
        both = F.concat(F.col(out)["matches"], F.col(f"{out}_next")["matches"])
        docs = docs.withColumn(out, F.struct(F.col(out)["n_words"].alias("n_words"), _hit_words(both).alias("n_hit"),
                                             both.alias("matches"))).drop(f"{out}_next")
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any window of a benchmark item; the columns stay as they were."""
    return find_leaks(docs, benchmark, "_leak").filter(F.col("_leak.n_hit") == 0).drop("_leak")


def op4_suffix_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_distinct(F.transform("leak.matches", lambda m: m["item_id"]))
    return found.select("doc_id", "leak.n_words", "leak.n_hit", ids.alias("ids")).select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("ids", lambda i: i.cast("string"))), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


#: The same rows by sets of windows.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
       regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM (
         SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
         FROM documents)),
b AS (SELECT item_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT rid, p, m, array_to_string(w[p:p + m - 1], ' ') AS g
       FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM d) JOIN ms ON p + m - 1 <= len(w)),
h AS (SELECT dw.rid, dw.p, dw.m, bw.item_id FROM dw JOIN bw USING (m, g)),
hw AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + m)) AS q FROM h) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)"""
