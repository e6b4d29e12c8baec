"""Many texts at once: pieces found in their bytes, each different one asked of the cache once."""
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cinespark.llm import packing, tokens
from cinespark.llm.tokens import Encoder

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def ids_of(enc, texts):
    out = []
    for first, blobs in enc.encode_rows(pa.array(texts, pa.string())):
        assert first == len(out)
        out += [np.frombuffer(b, enc.dtype).tolist() for b in blobs.to_pylist()]
    return out


@pytest.mark.parametrize("name", NAMES)
def test_ids_of_many_texts_equal_the_library(name, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 4000)
    path, rng = packing.tokenizer_path(name), random.Random(7)
    signs = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xC0, 0x100)]]
    texts = ["".join(rng.choices(signs, k=rng.randrange(60))) for _ in range(600)]
    texts += ["".join(rng.choices("ab'stredvlm  'LTS!\n12ß É\t", k=rng.randrange(30))) for _ in range(3000)]
    texts += ["", " ", "\n ", None, "x\0y", "\0", "a<|endoftext|> b'", "’s <|startoftext|>'S", "'", "'l", "'r", "a 's", "''s's", "日本 go's", "a×b÷c"] * 3
    texts += ["word " * 3000, "x" * 9000]                           # longer than a chunk
    rng.shuffle(texts)
    tok, enc = Tokenizer.from_file(path), Encoder(path, limit=50)
    for t, got in zip(texts, ids_of(enc, texts), strict=True):
        assert got == tok.encode(t or "", add_special_tokens=False).ids, t
    assert ids_of(enc, []) == [] and ids_of(enc, [None, ""]) == [[], []]


@pytest.mark.parametrize("name", NAMES)
def test_a_piece_is_asked_once_for_all_rows(name):
    enc = Encoder(packing.tokenizer_path(name))
    asked, cache = [], enc.pieces

    class Counted:
        def __getitem__(self, piece):
            asked.append(piece)
            return cache[piece]

    enc.pieces = Counted()
    ids_of(enc, ["The cat, the cat's hat.", "the  cat, the cat's hat.", "thé cat; the cat's hat."] * 50)
    assert len(asked) == len(set(asked)) and any("thé" in x for x in asked)
