import numpy as np
from ratewatch.llm import kdtree, queries

SCHEMA = "vec_id long, embedding array<double>, label int, score int"


def brute(rows, modulus, k=10):
    whole = []
    for number, vector in rows:
        usable = number is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector)
        if usable:
            whole.append((number, [int(np.floor(x * 1024)) for x in vector]))
    found = []
    for number, query in whole:
        if number % modulus == 0:
            best = sorted(
                (-sum(a * b for a, b in zip(query, other, strict=True)), n)
                for n, other in whole
                if n != number and len(other) == len(query)
            )
            found += [(number, rank, n, -score) for rank, (score, n) in enumerate(best[:k], 1)]
    return sorted(found)


def searched(spark, rows, modulus=7):
    frame = spark.createDataFrame([(n, v, 0, 0) for n, v in rows], SCHEMA)
    return sorted(map(tuple, kdtree.top_k(frame, modulus).collect()))


def test_same_as_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 150)
    monkeypatch.setattr(kdtree, "LEAF_ROWS", 8)
    monkeypatch.setattr(kdtree, "WAVE_ROWS", 20)
    vectors = rng.normal(size=(500, 6))
    vectors[100:260] = vectors[99]
    vectors[300:340] = vectors[300:340].round(1)
    rows = [(int(n), v.tolist()) for n, v in enumerate(vectors)]
    assert searched(spark, rows) == brute(rows, 7)


def test_what_takes_no_part_and_extremes(spark):
    rows = [
        (0, [1.0, 2.0]),
        (7, None),
        (14, [1.0, None]),
        (21, [float("nan"), 1.0]),
        (28, [float("inf"), 1.0]),
        (None, [1.0, 1.0]),
        (35, []),
        (36, []),
        (42, [1.0, 2.0, 3.0]),
        (3, [-0.0001, 0.0]),
        (4, [3.0e6, -3.0e6]),
        (49, [2.5e6, 4.1e6]),
    ]
    assert searched(spark, rows) == brute(rows, 7)
    assert searched(spark, []) == []


def test_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0])]
    assert searched(spark, rows) == brute(rows, 7)


def test_boxes_are_left_out():
    rng = np.random.default_rng(2)
    centers = rng.integers(-900, 900, (40, 3))
    vectors = np.repeat(centers, 200, axis=0) + rng.integers(-5, 5, (8000, 3))
    tree = kdtree.Tree(np.arange(8000), vectors)
    seen = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ np.asarray(other)

    query = vectors[5]
    bounds = np.maximum(query, 0) @ tree.high.T + np.minimum(query, 0) @ tree.low.T
    found = tree._best(5, query.astype(float), bounds.astype(float), vectors.astype(float).view(Counted), 10, None)
    scores = vectors @ query
    assert [s for s, _ in found] == sorted(np.delete(scores, 5).tolist(), reverse=True)[:10]
    assert sum(seen) < 2000


def test_every_row_but_the_own_one(spark, monkeypatch, tmp_path):
    """Repeated ids, rows without an id and other lengths are candidates of the query."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 60)
    monkeypatch.setattr(kdtree, "LEAF_ROWS", 8)
    vectors = [rng.normal(size=int(rng.choice([0, 1, 3, 6, 6, 6, 7, 9]))).round(2).tolist() for _ in range(300)]
    vectors += [None, [1.0, None], [float("nan")]] + [[-1.0, -1.0]] * 20
    ids = [None if n % 29 == 0 else int(rng.integers(-3, 40)) * 25 for n in range(len(vectors))]
    frame = spark.createDataFrame([(n, v, 0) for n, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<double>, label int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    whole = [
        (n, [int(np.floor(x * 1024)) for x in v])
        for n, v in zip(ids, vectors, strict=True)
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    wanted = []
    for at, (number, query) in enumerate(whole):
        if number is not None and number % 100 == 0:
            scores = [
                (-sum(a * b for a, b in zip(query, other, strict=False)), n is None, n)
                for place, (n, other) in enumerate(whole)
                if place != at
            ]
            best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:10]
            wanted += [(number, rank, n, -score) for rank, (score, _, n) in enumerate(best, 1)]
    got = [tuple(r) for r in queries.op1_kdtree_top_k(spark, str(tmp_path)).collect()]
    assert any(n is None for _, _, n, _ in wanted) and any(q == n for q, _, n, _ in wanted)
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_vectors_without_a_query(spark):
    assert searched(spark, [(1, [1.0, 2.0]), (2, [3.0, 1.0])]) == []
