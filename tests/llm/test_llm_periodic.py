import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from ratewatch.llm import periodic
from ratewatch.llm.queries import QUERIES


def plain_runs(words, least=12):
    """(start, length, period) by following every lag over the whole text."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        x = 0
        while x + q < len(words):
            begin = x
            while x + q < len(words) and words[x] == words[x + q]:
                x += 1
            if x - begin + q >= max(least, 2 * q) and x > begin:
                found.setdefault((begin, x - begin + q), q)
            x += 1
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def found_runs(texts, least):
    words, doc = [], []
    for i, text in enumerate(texts):
        words += [ord(c) for c in text] + [-1 - i]
        doc += [i] * len(text) + [-1]
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    out = [[] for _ in texts]
    for a, n, q in periodic.runs_in(np.array(words), np.array(doc), least).tolist():
        out[doc[a]].append((a - int(starts[doc[a]]), n, q))
    return out


@pytest.mark.parametrize("least", [2, 4, 5, 12])
def test_all_short_texts(least):
    texts = ["".join(t) for n in range(12) for t in itertools.product("ab", repeat=n)]
    assert found_runs(texts, least) == [plain_runs(t, least) for t in texts]


def test_texts_made_of_repeats():
    rng = random.Random(1)
    texts = []
    for _ in range(400):
        text = ""
        while len(text) < rng.randint(30, 250):
            unit = "".join(rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 6)))
            if text and rng.random() < 0.5:
                at = rng.randrange(len(text))
                unit = text[at : at + rng.randint(1, 40)]
            text += unit * rng.randint(1, 8)
        texts.append(text)
    assert found_runs(texts, 12) == [plain_runs(t) for t in texts]


def test_one_word_and_nested_squares_stay_near_linear():
    assert found_runs(["a" * 100_000], 12) == [[(0, 100_000, 1)]]
    odd = "ab" * 3000 + "a"
    assert len(found_runs([odd + odd], 12)[0]) == 3000


def test_documents(spark, make_docs):
    texts = {
        1: "a b c " * 5 + "end",
        2: None,
        3: " \n\t",
        4: "",
        5: "A b a b A b a b A b a b",
        6: "x " * 11,
        7: "x\x0bx\x0cx\r" * 4,
        8: "    " * 9,
        9: " ".join(f"w{i}" for i in range(3000)) * 2,
        None: "y " * 12,
    }
    docs = make_docs(*texts.items(), (1, texts[1])).withColumnRenamed("lang", "runs")
    rows = periodic.collapsed(docs).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[row.doc_id] or "")
        runs = plain_runs(words)
        assert row.n_words == len(words)
        assert [tuple(r) for r in row.runs] == runs
        assert row.text == plain_collapse(words, runs)
    assert periodic.collapsed(make_docs()).count() == 0


def test_slices_do_not_matter(spark, make_docs, prose, monkeypatch):
    docs = make_docs(*((i, prose(i, 40) + " " + "k l m " * (i % 7)) for i in range(60)))
    whole = sorted(periodic.collapsed(docs).collect())
    monkeypatch.setattr(periodic, "SLICE_BYTES", 100)
    assert sorted(periodic.collapsed(docs).collect()) == whole


def test_query_against_every_lag(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    compared = planted = 0
    for row in QUERIES["op11_periodic_runs"](spark, sf).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[row.doc_id] or "")
        n, h = len(words), zlib.crc32(str(row.doc_id).encode())
        if n > 800:
            continue
        if h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        exponent = best and 1000 * best[1] // best[2]
        assert (row.start, row.length, row.period, row.exponent_milli) == (*(best or (None,) * 3), exponent)
        lines = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
        assert (row.n_runs, row.runs_sha256) == (len(runs), hashlib.sha256(lines.encode()).hexdigest())
        assert row.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
        compared += 1
    assert compared > 100 and planted > 3
