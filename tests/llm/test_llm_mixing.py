from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from ratewatch.llm import mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: Fraction((3, 1, 2)[k % 3]) for k, s in enumerate(names)}
    left, target, free = Fraction(3, 2) * sum(sizes.values()), {}, set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = Fraction(2 * sizes[s])
            left -= target[s]
        free -= over
    return target


def test_targets(spark):
    for sizes in (
        {"a": 10, "b": 1000, "c": 30, None: 7, "é": 400, "Z": 90},
        {"x": 5},
        {None: 0, "q": 0},
        {"a": 1, "b": 1, "c": 1},
        {"a": 0, "b": 50, "c": 3},
    ):
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(frame).collect()}
        wanted = plain_targets(sizes)
        assert got.keys() == wanted.keys()
        assert all(abs(got[s] - float(wanted[s])) < 1e-6 for s in got)


def test_pivot_keeps_words_and_expected_values():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 500, 60).tolist()
    start = rng.random(60).tolist()
    sums = np.zeros(60)
    for seed in range(400):
        parts = [[f"k{i}", s, f] for i, (s, f) in enumerate(zip(sizes, start, strict=True))]
        mixing.pivot(parts, seed)
        assert sum(p[2] not in (0.0, 1.0) for p in parts) <= 1
        assert abs(sum(p[1] * p[2] for p in parts) - np.dot(sizes, start)) < 1e-6
        sums += [p[2] for p in parts]
    assert np.abs(sums / 400 - start).max() < 0.12


def test_settle_passes_on_what_is_left():
    rng = np.random.default_rng(5)
    sizes = sorted(rng.integers(1, 5000, 80).tolist(), reverse=True)
    start = rng.random(80)
    for seed in range(50):
        parts = [[f"k{i}", s, f] for i, (s, f) in enumerate(zip(sizes, start, strict=True))]
        mixing.settle(parts, seed)
        assert all(p[2] in (0.0, 1.0) for p in parts)
        assert abs(sum(p[1] * p[2] for p in parts) - np.dot(sizes, start)) < 500


def corpus(prose):
    rng = np.random.default_rng(6)
    rows = [(k, prose(k, int(rng.integers(1, 60))), "hot") for k in range(600)]
    rows += [(1000 + k, prose(k, int(rng.integers(1, 60))), f"s{k % 4}") for k in range(500)]
    rows += [(2000 + k, prose(k, 30), None) for k in range(60)]
    return [*rows, (3000, None, "hot"), (3001, "", "s1"), (3002, prose(1, 2500), "s2"), (None, prose(2, 9), "s3")]


def test_documents(make_docs, prose, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF_ROWS", 16)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rows = corpus(prose)
    docs = make_docs(*rows, rows[0], rows[0]).withColumnRenamed("lang", "size")
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows) + 2
    size_of = {n: len((t or "").split()) for n, t, _ in rows}
    source_of = {n: s for n, _, s in rows}
    sizes, taken, target = {}, {}, {}
    for r in got:
        source = source_of[r.doc_id]
        assert r.size == size_of[r.doc_id] and 0 <= r.taken <= 2 * r.size
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.taken
        target[source] = r.target
    wanted = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[source_of[r.doc_id]]
    for source in sizes:
        assert abs(target[source] - float(wanted[source])) < 1e-6
        assert abs(taken[source] - target[source]) <= 70
    own = [r.taken for r in got if r.doc_id == 0]
    assert max(own) - min(own) in (0, size_of[0])
    again = mixing.mixed(docs.repartition(7)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in again) == sorted((str(r.doc_id), r.taken) for r in got)


def test_copies_and_nothing(make_docs, prose):
    docs = make_docs((1, prose(1, 40), "a"), (2, prose(2, 40), "b"), (3, None, "b"), (4, prose(4, 40), None))
    docs = docs.withColumn("copies", F.lit(0))
    plan = {r.doc_id: r.copies for r in mixing.mixed(docs).collect()}
    got = mixing.copied(docs)
    assert got.columns == docs.columns
    found = [r.doc_id for r in got.collect()]
    assert sorted(found) == sorted(n for n, c in plan.items() for _ in range(c)) and plan[3] == 0
    assert mixing.mixed(make_docs()).count() == 0 and mixing.copied(make_docs()).count() == 0


def test_rows_that_repeat_come_near_the_target_together(make_docs, prose, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF_ROWS", 16)
    docs = make_docs(*[(1, prose(1, 300), "a")] * 50, *[(k, prose(k, 12), "a") for k in range(2, 9)])
    rows = mixing.mixed(docs).collect()
    assert len(rows) == 57 and all(r.taken <= 2 * r.size for r in rows)
    assert abs(sum(r.taken for r in rows) - rows[0].target) <= 300
    again = mixing.mixed(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)
    taken = mixing.copied(docs).groupBy("doc_id").count().collect()
    found = {}
    for r in rows:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.copies
    assert {r.doc_id: r["count"] for r in taken} == {k: n for k, n in found.items() if n}


def test_columns_with_the_operator_s_own_names(make_docs, prose):
    docs = make_docs((1, prose(1, 40), "a"), (1, prose(1, 40), "a"), (2, prose(2, 40), "b"))
    for name in ("key", "size", "copies", "of", "rows", "number", "__x"):
        docs = docs.withColumn(name, F.lit(name))
    got = mixing.copied(docs)
    assert got.columns == docs.columns and {(r.key, r.size, r.copies) for r in got.collect()} == {("key", "size", "copies")}
