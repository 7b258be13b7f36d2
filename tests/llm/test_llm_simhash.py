import random

import numpy as np
import xxhash

from ratewatch.llm import simhash
from test_llm_components import by_search


def plain_fingerprint(text, n=4):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [words[i : i + n] for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_plain_one(prose):
    for text in [None, "", " \n", "One", "a B\tc", "É é À b", "x y z", prose(1, 50), "a " * 9]:
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_the_code_is_perfect():
    nearest, one, two = simhash.golay_tables()
    weights = np.array([int(x).bit_count() for x in nearest[:, 0]])
    assert nearest.shape[1] == 1
    assert [int((weights == k).sum()) for k in range(4)] == [1, 23, 253, 1771]
    assert ((one >= 0).sum(axis=1) == np.where(weights == 3, 5, 0)).all()
    assert ((two >= 0).sum(axis=1) == np.select([weights == 2, weights == 3], [21, 16])).all()
    assert (simhash.syndromes(nearest[:, 0]) == np.arange(len(nearest))).all()


def test_prints_within_four_bits_share_a_key():
    rng = random.Random(5)
    tables = simhash.golay_tables()
    for _ in range(300):
        one = rng.getrandbits(64)
        two = one
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            two ^= 1 << bit
        rows, keys = simhash.bucket_keys(np.array([one, two], np.uint64).view(np.int64), tables)
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_components_are_those_of_all_pairs(spark):
    rng = random.Random(9)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for center in list(prints)[:6]:
        for _ in range(60):
            near = center
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                near ^= 1 << bit
            prints.add(near)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    found = {r.node: r.component for r in simhash.print_components(frame).collect()}
    assert found == by_search(links)


def test_documents(make_docs, prose):
    long = prose(4, 400)
    near = " ".join("changed" if k == 200 else w for k, w in enumerate(long.split()))
    docs = make_docs((5, long), (2, near), (9, prose(8, 300)), (4, None), (3, ""), (None, long), (7, prose(6, 5000)))
    docs = docs.withColumnRenamed("lang", "component_id")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    prints = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs).collect()}
    assert prints[4] == prints[3] == "0" * 16 and prints[None] == prints[5]
    bits = (int(prints[5], 16) ^ int(prints[2], 16)).bit_count()
    assert found[5] == found[None] == (2 if bits <= 4 else 5) and found[2] == 2
    assert found[4] == found[3] == 3 and found[9] == 9 and found[7] == 7
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {found[k] for k in found}


def test_repeated_rows_and_nothing(make_docs, prose):
    docs = make_docs((1, prose(1, 90)), (1, prose(1, 90)), (1, prose(2, 90)), (6, prose(1, 90)))
    assert simhash.near_duplicates(docs).count() == 4
    assert sorted(r.text for r in simhash.keep_one(docs).collect()) == sorted([prose(1, 90), prose(2, 90)])
    empty = make_docs()
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
