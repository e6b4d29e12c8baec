"""Operators 1, 3 and 9: wrappers, exact round trips, packing; and the pipeline."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cinespark.llm import huffman_ids, packing, wrappers
from cinespark.llm.common import scratch_dir
from cinespark.llm.tokens import Encoder


def whole(path):
    tok = Tokenizer.from_file(path)
    return lambda t: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_encoder_equals_the_library(rows, name):
    path = packing.tokenizer_path(name)
    enc, want = Encoder(path, limit=50), whole(path)
    odd = ["a  b", "foo \n bar", "\nfoo", "it's a 'test's", "tab\tx", "É́a b", "a\x1cb c", "<|endoftext|> x", "a b <|endoftext|>", "a b  <|endoftext|>  c d", " a b ", "a b\n <|endoftext|>\nc", " ", "<|endoftext|><|endoftext|>a", "a\t <|endoftext|> \tb", "a <|endoftext|> b", "a<|startoftext|>b c", "x <|ENDOFTEXT|>", "<|endoftext", "a\x85b  c", "1a6, b--c", "x\r\ny z", " "]
    for t in [*odd, *(r[1] or "" for r in rows)]:
        assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == want(t)[:-1].tolist()


def test_code_lengths():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 300, 3000):
        counts = rng.zipf(1.2, n).clip(1, 10**9)
        bits = huffman_ids.code_lengths(counts, 16)
        assert bits.max() <= 16 and (2.0 ** -bits).sum() <= 1
        code = huffman_ids.Code(np.arange(n) * 3, bits)
        parts = [rng.choice(np.arange(n) * 3, k) for k in (1, 255, 256, 257, 2000)]
        back = code.decode([(*code.encode(p), len(p)) for p in parts])
        assert all((a == b).all() for a, b in zip(parts, back))
    assert huffman_ids.code_lengths(np.array([1, 1, 2, 4]), 16).tolist() == [3, 3, 2, 1]


def test_ids_round_trip(spark, docs, rows, no_docs):
    path, out = packing.tokenizer_path("word_bpe_49k.json"), scratch_dir(spark)
    huffman_ids.write_ids(docs, path, out)
    got = sorted(huffman_ids.read_ids(spark, out).collect(), key=lambda r: r.start)
    want = whole(path)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: 1 << 70 if i is None else i)
    texts, at = {}, 0
    for r in rows:
        texts.setdefault(r[0], []).append(want(r[1]).tobytes())
    for r in got:
        assert bytes(r.ids) in texts[r.doc_id] and r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    empty = scratch_dir(spark)
    huffman_ids.write_ids(no_docs, path, empty)
    assert huffman_ids.read_ids(spark, empty).count() == 0


def test_packing(spark, docs, rows, no_docs):
    path = packing.tokenizer_path("byte_bpe_50k.json")
    want, texts = whole(path), {}
    for r in rows:
        texts.setdefault(r[0], []).append(want(r[1]))
    got = packing.pack(docs, path).collect()
    total = sum(len(x) for v in texts.values() for x in v)
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for x in texts[r.doc_id])
    assert sorted(by_seq) == list(range(-(-total // 2048)))
    for k, parts in by_seq.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or k == max(by_seq) and at == total % 2048
    assert packing.pack(no_docs, path).count() == 0


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(monkeypatch, dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = packing.hilbert(grid, bits)
    path = grid[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(len(grid))) and (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


PAGE = ("<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=x>Home</a></ul></nav><div class='ad'>buy {0}</div>"
        "<article><h1>Head {0}</h1><div>Same line.</div>{1}<aside>side</aside><div class=comments><p>I say {0}</p></div></article>"
        "<form><input>q</form><footer>&copy; {0}</footer></body></html>")


def test_wrappers(spark):
    pages = [(i, "http://a.b/x", PAGE.format(i, "".join(f"<p>Body &amp; {i}  {k}<br>" for k in range(1 + i % 3)))) for i in range(8)]
    pages += [(100, None, None), (101, "http://c/", ""), (102, "x", "plain  text"), (103, "http://d/", "<p>a<p>b"), (104, None, "<!-- x"), (3, *pages[3][1:])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    for i in range(8):                                # "Same line." is constant on the host's pages
        assert got[i] == "\n".join([f"Head {i}", *(f"Body & {i} {k}" for k in range(1 + i % 3))])
    assert [got[k] for k in (100, 101, 102, 103, 104)] == ["", "", "plain text", "a\nb", ""]
    host = wrappers.infer_wrappers(df).filter("host = 'a.b'").first()
    assert host.pages >= 8 and "<p> ( #TEXT )+ </>" in host.pattern
    assert wrappers.extract(df.limit(0)).count() == 0


def test_inline_furniture_does_not_part_a_block():
    assert wrappers.main_text("<article><p>one <span class='ad'>AD</span> two</p></article>", None) == "one two"


def test_alignment_makes_optional_and_repeated_groups():
    one = wrappers.page_wrapper(wrappers.blocks("<div><h2>a</h2><p>x</p></div>"))
    two = wrappers.page_wrapper(wrappers.blocks("<div><p>y</p><p>z</p><table><tr><td>t</table></div>"))
    s = wrappers.pattern(wrappers.align(one, two))
    assert s.startswith("<div> ( <h2>") and "</> )? <p> ( #TEXT )+ </>" in s and s.count(")?") == 2


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality rules", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "packing"]
    total = None
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.schema.names == docs.schema.names
        rows = [r.asDict() for r in out.collect()]
        assert all(r["n_chars"] == len(r["text"]) for r in rows) and len(rows) <= docs.count()
        docs = spark.createDataFrame(rows, docs.schema)
        total = len(rows)
    last = P.run(spark, sf)
    assert last.select("doc_id").distinct().count() == total
    assert last.agg(F.max("offset")).first()[0] < 2048
