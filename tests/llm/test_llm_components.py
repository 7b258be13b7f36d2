import random

from ratewatch.llm.components import connected


def by_search(pairs):
    near = {}
    for a, b in pairs:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    found = {}
    for start in sorted(near):
        queue = [start] if start not in found else []
        while queue:
            node = queue.pop()
            if node not in found:
                found[node] = start
                queue += near[node]
    return found


def test_components_are_those_of_a_search(spark):
    rng = random.Random(3)
    chain = [(k, k + 1) for k in range(1000, 1060)]
    hub = [(5000, k) for k in range(5001, 5300)]
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + chain + hub + [(7, 7)]
    found = connected(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == by_search(pairs)
    assert len(found) == len({r.node for r in found})


def test_nulls_and_nothing(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
    pairs = spark.createDataFrame([(None, 1), (2, None), (3, 3)], "a long, b long")
    assert connected(pairs).count() == 0
