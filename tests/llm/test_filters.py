"""Operators 4 and 6 against DuckDB, 5 and 8 on held-out rows, and their edge rows."""
import duckdb
import pytest
from pyspark.sql import functions as F

from cinespark.llm import decontaminate, langid, quality_qda, quality_rules, registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(registry.ORACLES))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    con.execute(f"CREATE VIEW o AS {registry.ORACLES[key]}")
    got = registry.QUERIES[key](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM o").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_rules_edges(docs, no_docs):
    got = {r.doc_id: r.judged for r in quality_rules.judge(docs).select("doc_id", "judged").collect()}
    for i in (7, 8, 9):
        assert got[i].n_words == 0 and got[i].base_failed and not got[i].kept
    assert got[2].kept and got[12].kept and got[12].n_words == 30000
    assert not got[11].kept and not got[17].kept and not got[18].kept
    assert got[16].kept and got[16].lines_removed == 1 and "|" not in got[16].clean_text
    kept = quality_rules.clean(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id = 16").first().n_chars == len(got[16].clean_text)
    assert quality_rules.clean(no_docs).count() == 0
    plan = quality_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_leaks(rows, items):
    import re
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for k, text in items:
            x = words(text)
            m = min(10, len(x))
            if m and k is not None:
                grams = {tuple(x[p:p + m]) for p in range(max(1, len(x) - 9))}
                at = [p for p in range(len(w) - m + 1) if tuple(w[p:p + m]) in grams]
                if at:
                    found.add(k)
                    hit |= {q for p in at for q in range(p, p + m)}
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def test_leaks_against_brute_force(spark, docs, rows):
    text = {i: t for i, t, *_ in rows}
    items = [(1, " ".join(text[2].split()[40:70])), (2, "one TWO"), (3, None), (4, "!!"), (None, "one two"), (5, "日本語 text"), (6, "one two"),
             (1, " ".join(text[2].split()[40:70])), (7, text[5]), (8, "of of of")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (1 << 20, 300):
        got = decontaminate.find_leaks(docs, bench, block_bytes=size)
        got = sorted(((r.doc_id, r.leak.n_words, r.leak.n_hit, sorted({m.item_id for m in r.leak.matches})) for r in got.collect()), key=repr)
        assert got == brute_leaks([(r[0], r[1]) for r in rows], items)
    m = decontaminate.find_leaks(docs, bench).filter("doc_id = 2").first().leak.matches
    assert (1, 0, 40, 30) in [tuple(x) for x in m]
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    with pytest.raises(ValueError):
        decontaminate.find_leaks(docs.withColumn("leak", F.lit(1)), bench)


def test_language_held_out(spark):
    got = langid.op5_rank_order(spark, "/root/testdata/sf0.01").filter("held_out").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang is not null").select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98


def test_language_edges(docs, no_docs):
    model = langid.learn_profiles(docs)
    got = {r.doc_id: r.language for r in langid.identify(docs, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (7, 8, 9)) and got[1].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.learn_profiles(no_docs) == {}
    assert {r.language.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}


def test_language_tie_goes_to_the_first_name():
    p = langid.Profiles({"b": [97, 98], "a": [97, 98]})
    assert p.predict("ab")[0] == "a"


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality_qda.op8_quadratic(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.97


def test_quality_edges(spark, docs, no_docs):
    measured = quality_qda.measure(docs)
    half = measured.select("features", (F.length("text") > 600).cast("int").alias("label")).filter("label is not null")
    for model, values in ((quality_qda.fit(half), None), (quality_qda.fit(half.filter("label = 1")), {1.0}), (quality_qda.fit(half.limit(0)), {0.5})):
        got = [r.score for r in quality_qda.score(measured, model).collect()]
        assert len(got) == docs.count() and all(0 <= s <= 1 for s in got) and (values is None or set(got) == values)
    assert quality_qda.measure(no_docs).count() == 0
