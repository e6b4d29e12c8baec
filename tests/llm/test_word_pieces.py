"""Texts of ASCII and Latin-1 letters are cut by the word tokenizer's own pattern."""
import random

import numpy as np
from tokenizers import Tokenizer

from cinespark.llm import packing
from cinespark.llm.tokens import Encoder

PATH = packing.tokenizer_path("word_bpe_49k.json")


def test_ids_of_simple_texts_equal_the_library():
    tok, enc, rng = Tokenizer.from_file(PATH), Encoder(PATH, limit=50), random.Random(5)
    signs = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xC0, 0x100)]]
    texts = ["".join(rng.choices(signs, k=rng.randrange(1, 60))) for _ in range(400)]
    texts += ["".join(rng.choices("ab'stredvlm D'!\n1×÷ß\x1c\x00́ ", k=30)) for _ in range(400)]
    texts += ["IT'S we'LL 'tis they're!'s ''ve a'd'm", "Straße ÀÉÎ ÿ Ÿ", "é'S É", "1,234.5 --'t", "'"]
    for t in texts:
        assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_a_word_is_made_once():
    enc, made = Encoder(PATH), []
    model = enc.model

    class Counted:
        def tokenize(self, form):
            made.append(form)
            return model.tokenize(form)

    enc.model = Counted()
    enc.encode("Thandou, THANDOU. thandou\nthandou; Énandou (thandou) Énandou!")
    assert len(made) == len(set(made)) and {w for w in enc.words if w.isalpha()} == {"thandou", "énandou"}
