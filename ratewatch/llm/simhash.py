"""SimHash near-duplicates: Golay-coded segments as join keys, links verified by bit distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.llm.components import connected
from ratewatch.llm.text import words
from ratewatch.session import forget, stored

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42

# The binary Golay code of 23 bits, 12 of them data: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY_BITS = 23
GOLAY_CHECK = 11
GOLAY_POLYNOMIAL = 0b110001110101

# Fingerprint bits by segment; the last is a shortened word.
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> int:
    """64 bits, each 1 if it is set in more than half of the shingle hashes; 0 without words."""
    found = words(text)
    if not found:
        return 0
    if len(found) < n:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(n)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int.from_bytes(np.packbits(majority).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of the column ``text`` as a signed long."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, n) for t in texts], dtype="int64")

    return F.pandas_udf(of, "long")(docs["text"])


def syndromes(word: np.ndarray) -> np.ndarray:
    """Remainder of every word by the code's polynomial."""
    rest = word.astype(np.int64)
    for bit in range(GOLAY_BITS - 1, GOLAY_CHECK - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY_POLYNOMIAL << (bit - GOLAY_CHECK)), rest)
    return rest


def golay_tables() -> list[np.ndarray]:
    """For every syndrome the error patterns that 0, 1 and 2 flipped bits can make the nearest.

    The code is perfect: each syndrome has exactly one pattern of up to 3 errors. A codeword
    that is 4 or 5 bits away is the nearest one after 1 or 2 flips. Rows are filled with -1.
    """
    one = 1 << np.arange(GOLAY_BITS, dtype=np.int64)
    tables = []
    for weights in ((0, 1, 2, 3), (4,), (5,)):
        chosen = [c for w in weights for c in combinations(range(GOLAY_BITS), w)]
        patterns = np.array([one[list(c)].sum() if c else 0 for c in chosen], np.int64)
        at = syndromes(patterns)
        order = np.argsort(at, kind="stable")
        at, patterns = at[order], patterns[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        table = np.full((1 << GOLAY_CHECK, place.max() + 1), -1, np.int64)
        table[at, place] = patterns
        tables.append(table)
    return tables


def codewords(segment: np.ndarray, tables: list[np.ndarray]) -> list[np.ndarray]:
    """Data bits of the codewords that 0, 1 and 2 flips lead to, one column each, or -1."""
    at = syndromes(segment)
    return [np.where(t[at] < 0, -1, (segment[:, None] ^ t[at]) >> GOLAY_CHECK) for t in tables]


def bucket_keys(prints: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All (row, key) of the fingerprints; a key joins a codeword of each segment.

    Of two fingerprints up to 4 bits apart, each is at most 2 flips from one between them, and
    by the pigeonhole principle these flips leave a segment without any. All codewords that 2
    flips in all can lead to, in one segment or in two, are keys; so both have those nearest
    to the one between them, and share a key.
    """
    bits = prints.view(np.uint64)
    near = [
        codewords(((bits >> np.uint64(start)) & np.uint64((1 << size) - 1)).astype(np.int64), tables)
        for start, size in SEGMENTS
    ]
    rows, keys = [], []
    number = np.arange(len(prints))
    for flips in product(range(MAX_BITS // 2 + 1), repeat=len(SEGMENTS)):
        if sum(flips) > MAX_BITS // 2:
            continue
        for a, b, c in product(*(near[k][f].T for k, f in enumerate(flips))):
            there = (a >= 0) & (b >= 0) & (c >= 0)
            rows.append(number[there])
            keys.append((a << 24 | b << 12 | c)[there])
    return np.concatenate(rows), np.concatenate(keys)


def keyed(prints: DataFrame) -> DataFrame:
    """(key, print) for every bucket of every distinct fingerprint."""

    def buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = golay_tables()
        for batch in batches:
            values = batch["print"].to_numpy(np.int64)
            rows, keys = bucket_keys(values, tables)
            yield pd.DataFrame({"key": keys, "print": values[rows]})

    # A fingerprint is a few bytes and has some hundred keys, so few partitions would be slow.
    width = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return prints.repartition(width, "print").mapInPandas(buckets, "key long, print long")


def _close(a: str, b: str, bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits


def print_components(prints: DataFrame) -> DataFrame:
    """(node, component) of all distinct fingerprints that have a link of up to 4 bits.

    First every member of a bucket is compared with the bucket's least fingerprint, which
    costs a comparison a member and joins groups of copies. Then only buckets that still
    hold several components are compared further: all members against those outside the
    bucket's largest component, so a large group is never compared with itself.
    """
    # Both uses of the keys share one exchange; buckets of one are left behind here.
    written = stored(keyed(prints), "keys")
    keys = written.repartition("key")
    sizes = keys.groupBy("key").agg(F.min("print").alias("first"), F.count("*").alias("n")).where("n > 1")
    members = stored(keys.join(sizes.hint("shuffle_hash"), "key"), "members")
    forget(written)
    stars = members.where((F.col("print") != F.col("first")) & _close("print", "first", MAX_BITS))
    found = stored(connected(stars.select("first", "print")), "groups")
    crowded = members.where("n > 2").select("key", "print")
    named = crowded.join(found, crowded["print"] == found["node"], "left").select(
        "key", "print", F.coalesce("component", "print").alias("component")
    )
    named = stored(named, "named")
    forget(members)
    counts = named.groupBy("key", "component").agg(F.count("*").alias("n"))
    top = counts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("m"))
    mixed = top.where("m > 1").select("key", F.col("top.component").alias("top"))
    rest = named.join(mixed, "key").where("component != top").select(
        "key", F.col("print").alias("other"), F.col("component").alias("apart")
    )
    across = named.join(rest, "key").where((F.col("component") != F.col("apart")) & _close("print", "other", MAX_BITS))
    joined = connected(across.select("component", "apart").distinct())
    joined = joined.select(F.col("node").alias("part"), F.col("component").alias("whole"))
    every = found.join(joined, found["component"] == joined["part"], "left")
    known = every.select("node", F.coalesce("whole", "component").alias("component"))
    # A part that was a lone fingerprint is in no star.
    lone = joined.join(found, joined["part"] == found["node"], "left_anti")
    return known.unionAll(lone.select("part", "whole"))


def near_duplicates(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document, linked at 4 bits or fewer.

    ``n`` words make a shingle. The bound of 4 bits is that of the key scheme, which finds
    every such pair. The component is the smallest id that can be reached. Null and empty
    texts, or texts without a word, have the fingerprint 0 and link like any other; a null id
    stands for a document but never names a component that has another id. Repeated rows
    are documents of their own with the same result. An empty table gives no rows.
    """
    marked = docs.select("doc_id", fingerprints(docs, n).alias("print"))
    marked = stored(marked, "prints")
    least = marked.groupBy("print").agg(F.min("doc_id").alias("least"))
    found = print_components(least.select("print"))
    named = least.join(found, least["print"] == found["node"], "left").select(
        "print", "least", F.coalesce("component", "print").alias("component")
    )
    named = stored(named, "named")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    joined = marked.join(named.join(ids, "component").select("print", "component_id"), "print")
    return joined.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """The documents without near-duplicates: of each component the one with its id.

    Of several rows with that id, one of each fingerprint in that component stays.
    """
    groups = near_duplicates(docs.select("doc_id", "text"), n)
    named = F.col("doc_id").eqNullSafe(F.col("component_id"))
    verdicts = groups.select(
        F.col("doc_id").alias("__id"), F.col("fingerprint").alias("__print"), named.alias("__named")
    )
    verdicts = stored(verdicts, "verdicts")
    ids = verdicts.groupBy("__id").agg(F.count("*").alias("__rows"), F.max("__named").alias("__any"))
    rows = docs.join(ids.where("__any"), docs["doc_id"].eqNullSafe(F.col("__id")))
    alone = rows.where("__rows = 1").drop("__id", "__rows", "__any")
    shared = rows.where("__rows > 1").drop("__id", "__rows", "__any")
    shared = shared.withColumn("__seen", F.lower(F.lpad(F.hex(fingerprints(docs, n)), 16, "0")))
    first = verdicts.where("__named").select("__id", "__print").distinct()
    one = shared.join(first, shared["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__seen") == F.col("__print")))
    return alone.unionAll(one.dropDuplicates(["doc_id", "__seen"]).drop("__seen", "__id", "__print"))
