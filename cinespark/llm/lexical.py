"""Operator 12, ranked lexical search by NRA (no random access) over impact-sorted lists.

Documents are read once for the terms that the items use (a posting: term, occurrences), and the counts of
the whole corpus follow: documents N, terms L, and documents of each term. Then shards of at most SHARD
documents answer every item on their own. A shard sorts the postings of each term by impact (what one
occurrence of the term in an item adds to the score). For an item its lists are read in step from the top, STEP
entries at first and four times as deep each round. What a document has been given so far is its lower bound;
the next unread impact of each list in which it has not been met is added for its upper bound. Once no unmet
document can reach the TOP-th lower bound, only met ones whose upper bound does are carried on, and reading
ends when each of their intervals has closed, so that membership, ties and scores are all exact. The best
rows of all shards meet in a window by item, limited in each task before the shuffle.

Nothing is shuffled but these best rows: TOP for each item and shard. A frequent term is split over shards like
any other. Items come in blocks of at most BLOCK_BYTES of text on average (by the hash of their text), whose
vocabulary is broadcast; documents are read again for each block. Words are told by 64-bit hashes.

Defined results: null and empty texts have no terms, so such documents are never found and such items have
no rows; each row of the benchmark is an item, repeated ones give their rows again, a null item_id stays null;
repeated documents are ranked each; null doc_ids come last among equal scores; empty tables give no rows;
other columns are not needed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinespark.llm.common import ALNUM, LOWER, joined, shards, span_hashes, stored, table, utf8_list, word_spans

TOP = 10
SHARD = 1 << 14
STEP = 256
BLOCK_BYTES = 4 << 20


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and the place of each text's first one (one more than the texts)."""
    buf, offsets = joined(texts)
    low = LOWER[buf]
    starts, ends = word_spans(low, ALNUM)
    return span_hashes(low, starts, ends), np.searchsorted(starts, offsets)


class Items:
    """Vocabulary of a block of items, and each item's terms with their repeats."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in rows]
        hashes, first = hashed_words([(t or "").encode("utf-8", "replace") for _, t in rows])
        self.vocab, terms = np.unique(hashes, return_inverse=True)
        self.terms = [np.unique(terms[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:])]
        size = 1 << max(16, (16 * len(self.vocab)).bit_length())
        self.sieve, self.mask = np.zeros(size, bool), np.uint64(size - 1)
        self.sieve[self.vocab & self.mask] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words of the vocabulary stand, and which they are."""
        at = np.flatnonzero(self.sieve[hashes & self.mask])
        found = hashes[at]
        term = np.searchsorted(self.vocab, found)
        same = self.vocab[np.minimum(term, len(self.vocab) - 1)] == found
        return at[same], term[same]


def _postings(items):
    def run(batches):
        test = items.value
        for batch in batches:
            texts = utf8_list(batch.column(1))
            size, terms, times, many = [], [], [], []
            for a, b in shards(texts):
                hashes, first = hashed_words(texts[a:b])
                at, term = test.places(hashes)
                doc = np.searchsorted(first, at, "right") - 1
                pairs, n = np.unique(doc * max(len(test.vocab), 1) + term, return_counts=True)
                size.append(np.diff(first))
                terms.append(pairs % max(len(test.vocab), 1))
                times.append(n)
                many.append(np.bincount(pairs // max(len(test.vocab), 1), minlength=b - a))
            flat = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)
            ends = np.concatenate([[0], np.cumsum(flat(many, np.int64))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(flat(size, np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat(terms, np.int32))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat(times, np.int64)))], names=["doc_id", "n", "terms", "times"])
    return run


def _document_counts(size: int):
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["term", "df"])
    return run


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Lists:
    """Impact-sorted lists of a shard's documents."""

    def __init__(self, sizes: np.ndarray, many: np.ndarray, terms: np.ndarray, times: np.ndarray, weights: np.ndarray,
                 n_docs: int, n_terms: int):
        self.docs = len(sizes)
        if 75 * int(sizes.max(initial=0)) * n_docs >= 1 << 63:
            m = np.array([25 + 75 * n * n_docs // n_terms for n in sizes.tolist()], np.int64)
        else:
            m = 25 + 75 * sizes * n_docs // max(n_terms, 1)
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), many)
        impact = weights[terms] * (1_000_000_000 * times // (1000 * times + 8 * m[doc]))
        by = np.lexsort((-impact, terms))
        by = by[impact[by] > 0]
        self.doc, self.impact = doc[by], impact[by]
        self.start = np.searchsorted(terms[by], np.arange(len(weights) + 1))

    def best(self, terms: np.ndarray, repeats: np.ndarray, order: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the ``top`` greatest scores above 0, ties by ``order``; and how many entries were read."""
        lists = [(self.doc[a:b], self.impact[a:b] * q) for a, b, q in zip(self.start[terms], self.start[terms + 1], repeats) if b > a]
        lower = np.zeros(self.docs, np.int64)
        live = None                                                  # documents carried on, once no unmet one can matter
        depth, done = STEP, 0
        read = [0] * len(lists)
        while True:
            for j, (doc, impact) in enumerate(lists):
                to = min(depth, len(doc))
                new, gain = doc[read[j]:to], impact[read[j]:to]
                if live is not None:
                    held = live[new]
                    new, gain = new[held], gain[held]
                lower[new] += gain
                done += to - read[j]
                read[j] = to
            bounds = [int(impact[r]) if r < len(impact) else 0 for r, (_, impact) in zip(read, lists)]
            unmet = sum(bounds)
            met = np.flatnonzero(lower if live is None else live)
            least = int(np.partition(lower[met], len(met) - top)[len(met) - top]) if len(met) >= top else 0
            upper = lower + unmet
            for r, bound, (doc, _) in zip(read, bounds, lists):
                if bound:
                    upper[doc[:r]] -= bound
            if unmet < least or not unmet:
                met = met[upper[met] >= least]
                if (upper[met] == lower[met]).all():
                    break
                live = np.zeros(self.docs, bool)
                live[met] = True
            depth *= 4
        met = met[lower[met] > 0]
        met = met[np.lexsort((order[met], -lower[met]))][:top]
        return met, lower[met], done


def _search(items, weights, n_docs: int, n_terms: int, top: int):
    def answer(rows):
        test = items.value
        ids = pa.concat_arrays([r.column(0) for r in rows])
        flat = lambda k: np.concatenate([r.column(k).flatten().to_numpy() for r in rows])
        sizes = np.concatenate([r.column(1).to_numpy() for r in rows])
        many = np.concatenate([r.column(2).value_lengths().to_numpy() for r in rows])
        lists = Lists(sizes, many, flat(2), flat(3), weights.value, n_docs, n_terms)
        last = np.append(ids.fill_null(0).to_numpy(), 0)[:-1]
        order = np.empty(len(ids), np.int64)
        order[np.lexsort((last, ids.is_null().to_numpy(zero_copy_only=False)))] = np.arange(len(ids))
        item, doc, score = [], [], []
        for k, (terms, repeats) in enumerate(test.terms):
            d, s, _ = lists.best(terms, repeats, order, top)
            item.append(np.full(len(d), k)), doc.append(d), score.append(s)
        where = np.concatenate([*item, np.zeros(0, np.int64)]).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(where), pa.array(test.ids, pa.int64()).take(pa.array(where)),
             ids.take(pa.array(np.concatenate([*doc, np.zeros(0, np.int64)]).astype(np.int64))),
             pa.array(np.concatenate([*score, np.zeros(0, np.int64)]))], names=["item", "item_id", "doc_id", "score"])

    def run(batches):
        rows, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = min(SHARD - n, batch.num_rows - at)
                rows.append(batch.slice(at, take))
                at, n = at + take, n + take
                if n == SHARD:
                    yield answer(rows)
                    rows, n = [], 0
        if rows:
            yield answer(rows)
    return run


def _ranked(docs: DataFrame, rows: list[tuple[int | None, str | None]], top: int) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    test = Items(rows)
    items = sc.broadcast(test)
    found = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _postings(items), "doc_id long, n long, terms array<int>, times array<long>"))
    n_docs, n_terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(max(len(test.vocab), 1), np.int64)
    for r in (found.select("terms").mapInArrow(_document_counts(len(df)), "term long, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()):               # at most the vocabulary
        df[r["term"]] = r["df"]
    weights = sc.broadcast(term_weights(n_docs, df))
    best = found.mapInArrow(_search(items, weights, n_docs, n_terms, top), "item long, item_id long, doc_id long, score long")
    by = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each row (item_id, text) of ``items``."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes + 1
    out = None
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        part = _ranked(docs, [tuple(r) for r in rows], top)
        out = part if out is None else out.unionByName(part)
    return out


def op12_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

#: The same rows from all scores.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
c AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
m AS (SELECT rid, doc_id, 25 + (75 * len(w)::BIGINT * n_docs) // greatest(n_terms, 1) AS m FROM d, c),
q AS (SELECT k, item_id, term, count(*) AS q FROM (SELECT k, item_id, unnest(w) AS term
      FROM (SELECT row_number() OVER () AS k, item_id, {_TERMS} AS w FROM benchmark)) GROUP BY k, item_id, term),
s AS (SELECT q.k, q.item_id, m.rid, m.doc_id,
             sum(q * CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
                 * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN df USING (term) JOIN m ON m.rid = tf.rid, c GROUP BY q.k, q.item_id, m.rid, m.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= {TOP}"""
