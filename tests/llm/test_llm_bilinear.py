import math
import re
import zlib
from collections import Counter

import numpy as np

from ratewatch.llm import bilinear


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def held(number):
    return number is not None and zlib.crc32(str(number).encode()) % 7 == 2


def two_languages(prose):
    rows = []
    for k in range(300):
        mark = "x" if k % 2 else "y"
        rows.append((k, " ".join(f"{w}{mark}" for w in prose(k, 120, 300).split())))
    return rows


def test_base_counts_and_probabilities(make_docs, prose):
    rows = [*two_languages(prose), (900, None), (901, ""), (902, "Mixed CASE É"), (None, "one two"), (0, "again")]
    docs = make_docs(*rows, (5000, prose(1, 20_000))).withColumnRenamed("lang", "score")
    rows = [*rows, (5000, prose(1, 20_000))]
    got = bilinear.scored(docs).collect()
    counts = Counter(t for n, x in rows if not held(n) for t in tokens(x))
    total, distinct = sum(counts.values()), len(counts)
    wanted = {}
    for number, text in rows:
        found = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in found)
        wanted.setdefault(number, []).append((held(number), len(found), sum(counts[t] > 0 for t in found), total, base))
    assert len(got) == len(rows)
    for r in got:
        near = [w for w in wanted[r.doc_id] if w[:4] == (r.held_out, r.n_tokens, r.n_known, r.train_tokens)]
        assert any(abs(w[4] - r.base_score) < 1e-6 * abs(w[4]) + 1e-9 for w in near)
        assert r.score < 0 and math.isfinite(r.score)
    apart = [r for r in got if r.held_out and r.n_tokens > 50]
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart)


def test_symbols_sum_to_one():
    symbols = bilinear.Symbols({b"a": 0, b"b": 1}, np.arange(3.0 + bilinear.CLASSES))
    model = bilinear.Model.fresh(symbols)
    contexts = np.array([[0, 5, 7], [1, 2, 0]])
    logs = model.log_normalisers(contexts)
    n = len(symbols.counts)
    for k in range(3):
        every = np.repeat(contexts[:, k : k + 1], n, axis=1)
        scores = model.scores(every, np.arange(n))
        assert abs(np.exp(scores - logs[k]).sum() - 1) < 1e-4
        placed = sum(t[c, np.arange(n)] for t, c in zip(model.by_place(), every, strict=True))
        assert np.allclose(placed, scores, atol=1e-5)


def test_noise_contrast_learns_what_follows():
    rng = np.random.default_rng(3)
    symbols = bilinear.Symbols({f"{k}".encode(): k for k in range(10)}, np.r_[np.full(10, 100.0), 1, np.zeros(bilinear.CLASSES)])
    chain = [0]
    for _ in range(60_000):
        chain.append((chain[-1] + 1) % 10 if rng.random() < 0.8 else int(rng.integers(10)))
    targets = np.array(chain, np.int32)
    contexts = bilinear.contexts_of(targets, symbols.end)
    trainer = bilinear.Trainer(bilinear.Model.fresh(symbols), symbols, 1)
    for start in range(0, len(targets), 500):
        trainer.batch(contexts[:, start : start + 500], targets[start : start + 500])
    model = trainer.model
    pair = np.array([[4], [3]])
    scores = np.array([model.scores(pair, np.array([k]))[0] for k in range(10)]) - model.log_normalisers(pair)[0]
    assert scores.argmax() == 5 and 0.6 < math.exp(scores[5]) < 0.95


def test_contexts():
    assert bilinear.contexts_of(np.array([4, 5, 6]), 9).tolist() == [[9, 4, 5], [9, 9, 4]]
    assert bilinear.contexts_of(np.array([9]), 9).tolist() == [[9], [9]]


def test_nothing(make_docs):
    assert bilinear.scored(make_docs()).count() == 0
    only_held = next(n for n in range(100) if held(n))
    (row,) = bilinear.scored(make_docs((only_held, "never seen"))).collect()
    assert (row.n_known, row.train_tokens, row.base_score) == (0, 0, 0.0) and row.score < 0
