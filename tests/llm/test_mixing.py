"""Operator 13 against a plain version, its targets, and awkward tables."""
import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cinespark.llm import mixing

COLUMNS = "doc_id long, text string, source string"


def plain_targets(sizes: dict) -> dict:
    """Shares of the whole by weight; what is over three times a source's size goes to the others again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        part = {s: (total - sum(held.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if part[s] > 3 * sizes[s]]
        if not over:
            return {**held, **part}
        held.update({s: 3 * sizes[s] for s in over})


def plain(rows):
    """(doc_id, size, target, copies) with the seed nearest to the target."""
    docs, sizes = [], defaultdict(int)
    for i, t, s in rows:
        digest = hashlib.md5(f"{'null' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()
        docs.append((i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), int(digest[:8], 16), int(digest[8:16], 16)))
        sizes[s] += docs[-1][2]
    targets, out = plain_targets(sizes), []
    for s, target in targets.items():
        rate = target / sizes[s] if sizes[s] else 0.0
        times, fraction = int(rate), rate - int(rate)
        own = [d for d in docs if d[1] == s]
        draws = [[(a + k * b) % (1 << 32) < fraction * (1 << 32) for *_, a, b in own] for k in range(mixing.SEEDS)]
        off = [abs(sum(d[2] for d, x in zip(own, y) if x) - (target - times * sizes[s])) for y in draws]
        out += [(d[0], d[2], sizes[s], target, d[2] * (times + x)) for d, x in zip(own, draws[off.index(min(off))])]
    return sorted(out, key=repr)


def got(df):
    out = mixing._hashed(df, F.col("doc_id"))
    out = mixing._join(out, mixing.source_rates(out)).withColumn("copies", mixing._copies())
    return sorted((tuple(r) for r in out.select("doc_id", "size", "source_size", "target", F.col("size") * F.col("copies")).collect()), key=repr)


@pytest.fixture(scope="module")
def mixed_rows(rows):
    """A hot source, one far below its share, one without words, a null one, repeated rows, null ids."""
    out = [(i, t, None if k % 9 == 0 else "ab"[k % 2]) for k, (i, t, *_) in enumerate(rows)]
    out += [(1000 + k, "word " * (1 + k % 40), "hot") for k in range(400)]
    out += [(2000, "tiny text", "small"), (2001, None, "bare"), (2002, " \n", "bare"), (2003, "é 漢字 \U0001F600", ""), (1000, "word ", "hot")]
    return out


def test_equals_the_plain_version(spark, mixed_rows):
    df = spark.createDataFrame(mixed_rows, COLUMNS).repartition(5)
    a, b = got(df), plain(mixed_rows)
    assert [x[:3] + x[4:] for x in a] == [x[:3] + x[4:] for x in b]
    assert [x[3] for x in a] == pytest.approx([x[3] for x in b])


def test_takes_come_near_the_targets_and_reruns_agree(spark):
    sf = "/root/testdata/sf0.01"
    first = mixing.op13_weighted_mix(spark, sf).cache()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert first.count() == docs.count() and first.filter(F.col("taken") > 3 * F.col("size")).count() == 0
    by = (first.join(docs.select("doc_id", "source"), "doc_id").groupBy("source")
          .agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("longest")).collect())
    assert all(abs(r["taken"] - r["target"]) <= 0.02 * r["target"] for r in by), by
    assert sum(r["target"] for r in by) == pytest.approx(first.agg(F.sum("size")).first()[0])
    again = mixing.op13_weighted_mix(spark, sf)
    assert first.exceptAll(again).count() == 0


def test_mix_emits_whole_rows_as_often_as_taken(spark, mixed_rows):
    names = ["doc_id", "text", "source", "size", "copies", "copy", "row", "a", "b", "name", "target", "place", "__salt", "drawn"]
    df = spark.createDataFrame([(*r, *range(len(names) - 3)) for r in mixed_rows], COLUMNS + "".join(f", {n} int" for n in names[3:]))
    out = mixing.mix(df)
    assert out.columns == names
    taken = {(i, n): k for i, n, _, _, k in plain(mixed_rows)}
    times = Counter((r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in out.collect())
    for key, n in Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _ in mixed_rows).items():
        if key[0] is not None and key[1] and n == 1:
            assert times[key] * key[1] == taken[key]
    assert out.filter("source = 'small'").count() == 3 and out.filter("source = 'bare'").count() == 0


def test_salted_join_gives_the_same(spark, mixed_rows, monkeypatch):
    df = spark.createDataFrame(mixed_rows, COLUMNS)
    want = got(df)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert got(df) == want


def test_empty_and_wordless_tables(spark):
    df = spark.createDataFrame([], COLUMNS)
    assert got(df) == [] and mixing.mix(df).count() == 0
    df = spark.createDataFrame([(1, None, "a"), (None, "  ", None)], COLUMNS)
    assert [r[1:] for r in got(df)] == [(0, 0, 0.0, 0)] * 2 and mixing.mix(df).count() == 0
