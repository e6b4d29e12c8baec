"""Operator 12 against scores of all documents, and the intervals of its reads."""
import math
import re
from collections import Counter

import numpy as np
import pytest

from cinespark.llm import lexical

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, top=10):
    """Every document's score for every item, the best of them."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms(text) if b[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


def got(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string").repartition(3)
    q = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in lexical.search(d, q, **kw).collect()), key=repr)


@pytest.fixture(scope="module")
def corpus(rows):
    """Copies (ties), a term of a third of all documents, null ids and texts, a very long text."""
    docs = [(i, t) for i, t, *_ in rows] + [(100 + k, "hot " * (1 + k % 3) + f"w{k % 20} Zebra9") for k in range(60)]
    return docs + [(100, "hot w0 Zebra9"), (None, "hot w3"), (None, "hot w3"), (500, "ÀÉ x₂ 日本")]


@pytest.fixture(scope="module")
def items(rows):
    return [(1, "HOT hot w3"), (2, "w3 zebra9 w4"), (3, rows[0][1]), (4, rows[1][1] + " hot"), (5, None), (6, "  !! "), (None, "w7 hot"),
            (2, "w3 zebra9 w4"), (7, "nowhere"), (8, "ÀÉ 日本 x₂"), (9, "of the a one two"), (2, "x")]


def test_equals_all_scores(spark, corpus, items):
    want = plain(corpus, items)
    assert got(spark, corpus, items) == want
    assert got(spark, corpus, items, block_bytes=300) == want            # several blocks of items


def test_shards_of_a_few_documents(corpus, items):
    """Any way to cut the documents gives the same best rows."""
    test = lexical.Items(items)
    hashes, first = lexical.hashed_words([(t or "").encode() for _, t in corpus])
    for size in (1, 7, 1000):
        found = []
        n = np.diff(first)
        n_docs, n_terms = int((n > 0).sum()), int(n.sum())
        at, term = test.places(hashes)
        doc = np.searchsorted(first, at, "right") - 1
        pairs, times = np.unique(doc * len(test.vocab) + term, return_counts=True)
        doc, term = pairs // len(test.vocab), pairs % len(test.vocab)
        weights = lexical.term_weights(n_docs, np.bincount(term, minlength=len(test.vocab)))
        for a in range(0, len(corpus), size):
            own = (doc >= a) & (doc < a + size)
            lists = lexical.Lists(n[a:a + size], np.bincount(doc[own] - a, minlength=len(n[a:a + size])), term[own], times[own], weights, n_docs, n_terms)
            order = np.array([k for k in np.argsort(np.argsort([(1 << 62) if i is None else i for i, _ in corpus[a:a + size]], kind="stable"))])
            for k, (t, q) in enumerate(test.terms):
                d, s, _ = lists.best(t, q, order)
                found += [(k, -int(y), corpus[a + x][0]) for x, y in zip(d, s)]
        best = []
        for k, (item, _) in enumerate(items):
            own = sorted((s, i is None, i or 0, i) for j, s, i in found if j == k)[:10]
            best += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(own)]
        assert sorted(best, key=repr) == plain(corpus, items)


def test_reading_ends_before_the_lists_do():
    """A clear winner set in steep lists needs few entries; flat lists are read to their end."""
    n = 20_000
    steep, flat = object.__new__(lexical.Lists), object.__new__(lexical.Lists)
    for lists, impact in ((steep, np.maximum(1, 10**9 // (1 + np.arange(n)) ** 2)), (flat, np.full(n, 7))):
        lists.docs, lists.doc, lists.impact = n, np.tile(np.arange(n, dtype=np.int32), 2), np.tile(impact, 2)
        lists.start = np.array([0, n, 2 * n])
    d, s, read = steep.best(np.array([0, 1]), np.array([1, 2]), np.arange(n))
    assert d.tolist() == list(range(10)) and s[0] == 3 * 10**9 and read < n / 10
    d, s, read = flat.best(np.array([0, 1]), np.array([1, 1]), np.arange(n)[::-1])
    assert d.tolist() == list(range(n - 1, n - 11, -1)) and set(s.tolist()) == {14} and read == 2 * n


def test_random_lists_with_ties():
    rng = np.random.default_rng(7)
    for _ in range(60):
        n, k = int(rng.integers(1, 900)), int(rng.integers(1, 7))
        lists = object.__new__(lexical.Lists)
        lists.docs, docs, impacts, total = n, [], [], np.zeros(n, np.int64)
        for _ in range(k):
            doc = rng.permutation(n)[:int(rng.integers(0, n + 1))].astype(np.int32)
            impact = np.sort(rng.integers(1, int(rng.choice([2, 5, 1000])) + 1, len(doc)))[::-1]
            docs.append(doc), impacts.append(impact)
        q = rng.integers(1, 4, k)
        for doc, impact, r in zip(docs, impacts, q):
            total[doc] += impact * r
        lists.doc, lists.impact = np.concatenate(docs), np.concatenate(impacts)
        lists.start = np.cumsum([0, *map(len, docs)])
        order = rng.permutation(n)
        d, s, _ = lists.best(np.arange(k), q, order)
        want = [x for x in np.lexsort((order, -total)) if total[x] > 0][:10]
        assert d.tolist() == want and s.tolist() == total[want].tolist()


def test_empty_tables(spark, corpus, items):
    d = spark.createDataFrame([], "doc_id long, text string")
    q = spark.createDataFrame([(i, t) for i, t in items], "item_id long, text string")
    assert lexical.search(d, q).count() == 0
    assert lexical.search(spark.createDataFrame(corpus, "doc_id long, text string"), q.limit(0)).count() == 0
