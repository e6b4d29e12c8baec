"""Operators 2, 7 and 10 against brute force, and the two-stage sort on random segments."""
import hashlib
import random
import re

import numpy as np

from cinespark.llm import jaccard_join, passages, suffix_dedup
from cinespark.llm.components import components
from cinespark.llm.two_stage import common_prefixes, suffix_order

LAST = (1 << 63) - 1


def test_two_stage_order():
    rng = random.Random(1)
    for trial in range(150):
        width, letters = rng.choice([3, 5, 8]), rng.choice([b"ab", b"a\x00b", bytes(range(256))])
        segments = [bytes(rng.choice(letters) for _ in range(rng.randint(width, 30))) for _ in range(rng.randint(1, 12))] + [b"a" * rng.randint(width, 40)]
        starts, linked, at = [], [], 0
        for s in segments:
            n = len(s) - width + 1
            starts += range(at, at + n)
            linked += [True] * (n - 1) + [False]
            at += len(s)
        text = b"".join(segments)
        order, keys = suffix_order(np.frombuffer(text, np.uint8), np.array(starts), np.array(linked), width)
        found = [text[starts[i]:starts[i] + width] for i in order]
        assert sorted(order.tolist()) == list(range(len(starts))) and found == sorted(found)
        lcp = common_prefixes(keys, order)
        assert [k == width for k in lcp[1:]] == [x == y for x, y in zip(found, found[1:])]


def brute_repeats(rows, window=50):
    first = {}
    for i, t in rows:
        for k in range(len(t) - window + 1):
            g = t[k:k + window]
            first[g] = min(first.get(g, i), i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - window + 1):
            if first[t[k:k + window]] < i:
                gone[k:k + window] = b"\1" * window
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((None if i == LAST else i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeats_against_brute_force(docs, rows, no_docs):
    plain = [(LAST if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    got = suffix_dedup.remove_repeats(docs.withColumn("key", docs.doc_id))
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in got.select(cols).collect()), key=repr) == brute_repeats(plain)
    assert {r.doc_id: r.text for r in got.collect()}[3] == "" and got.columns[:6] == [*docs.columns, "key"]
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def brute_near(rows, threshold=0.8):
    def shingles(t):
        w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) if x]
        return frozenset([tuple(w[k:k + 5]) for k in range(len(w) - 4)] if len(w) > 4 else [tuple(w)] if w else [])
    keyed = [(LAST if i is None else i, shingles(t)) for i, t in rows]
    sets = list(dict.fromkeys(s for _, s in keyed))
    least = {s: min(i for i, x in keyed if x == s) for s in sets}
    near = {s: {x for x in sets if x != s and s and x and len(s & x) >= threshold * len(s | x)} for s in sets}
    group = {}
    for s in sorted(sets, key=lambda s: least[s]):
        todo = [s]
        while todo:
            x = todo.pop()
            if x not in group:
                group[x] = least[s]
                todo += near[x]
    name = lambda i: None if i == LAST else i
    return sorted(((name(i), name(least[s]), name(group[s]), len(near[s])) for i, s in keyed), key=repr)


def test_near_duplicates_against_brute_force(spark, docs, rows, no_docs, monkeypatch):
    want = brute_near([(r[0], r[1]) for r in rows])
    got = jaccard_join.near_duplicates(docs.withColumn("cls", docs.doc_id))
    assert sorted(map(tuple, got.select("doc_id", "set_id", "class_id", "n_links").collect()), key=repr) == want
    assert jaccard_join.near_duplicates(no_docs).count() == 0
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and {2, 5, 6} <= {r.doc_id for r in kept.collect()} and not {3, 4} & {r.doc_id for r in kept.collect()}


def test_large_group_in_blocks(spark, monkeypatch):
    """A group of near copies over several blocks: same links, and one class."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rng, words = random.Random(4), [f"w{k}" for k in range(400)]
    rows = []
    for i in range(60):
        w = list(words)
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(400)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_near(rows)


def test_posterior_bounds():
    least = jaccard_join.least_matches()
    assert least == sorted(least) and 70 < least[-1] < 95


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 200), (200, 300), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[k] for k in range(51)} == {0} and {got[k] for k in (100, 200, 300)} == {100}


def test_passages(spark, docs, rows, no_docs):
    got = passages.shared_passages(docs).collect()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    by_id = {r[0]: word.findall((r[1] or "").lower()) for r in rows}
    found = {(r.doc_id, r.source_id) for r in got}
    assert {(3, 1), (4, 2), (6, 5)} <= found and not {7, 8, 9, 10} & {d for d, _ in found}
    r = next(r for r in got if (r.doc_id, r.source_id) == (6, 5))
    assert by_id[6][r.start_word:r.end_word] == by_id[5][r.source_start:r.source_end] and r.end_word - r.start_word >= 60
    near = next(r for r in got if r.doc_id == 4)
    assert 0.9 < near.identity < 1 and near.end_word - near.start_word >= 195
    assert passages.shared_passages(no_docs).count() == 0


def test_chain_is_collinear_and_best():
    x, y = [0, 10, 20, 30, 15], [5, 15, 25, 35, 2]
    assert passages.chains(x, y)[0] == [0, 1, 2, 3]


def test_seeds_of_repeated_words_stay_sparse():
    words = np.full(5000, 7, np.uint64)
    assert len(passages.seeds(words)[1]) <= 5000 // passages.WINDOW + 2
