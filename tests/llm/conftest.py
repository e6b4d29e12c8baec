import random

import pytest

WORDS = [a + b for a in "ba co di fe gu ha je ki lo mu".split() for b in ("", "n", "ral", "mist", "tor", "vex", "s")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + ("." if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages, nulls, ties, junk and a long text."""
    a, b, shared = prose(1, 120), prose(2, 200), prose(3, 60)
    near = b.split()
    near[100] = "xyzzy"
    texts = [(1, a), (2, b), (3, a), (4, " ".join(near)), (5, prose(4, 80) + " " + shared + " " + prose(5, 70)),
             (6, prose(6, 30) + " " + shared), (7, None), (8, ""), (9, "   \n\t "), (10, "one two"), (11, "Of " * 400),
             (12, prose(7, 30000)), (13, "a" * 5000), (14, "a" * 300 + "b" * 300), (5, prose(4, 80) + " " + shared + " " + prose(5, 70)),
             (None, a), (None, prose(8, 90)), (15, "É́ß naïve – 日本語 text with \x00 odd   marks. " * 12), (16, prose(9, 70) + "\n" + "x | y | z | " * 9),
             (17, "THE,!! " * 80), (18, "a### b$$$ c%%% " * 40)]
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


def as_set(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
