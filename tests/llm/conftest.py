import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def prose():
    """A function of a seed and a number of words that gives a text of made-up words."""

    def make(seed, n, vocabulary=4000):
        rng = random.Random(seed)
        return " ".join(f"w{int(vocabulary * rng.random() ** 2):x}" for _ in range(n))

    return make
