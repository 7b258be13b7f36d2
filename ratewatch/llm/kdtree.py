"""Exact top-k by inner product: a KD-tree per shard, searched best box first."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewatch.session import stored

K = 10
SCALE = 1024

# Vectors of a shard, vectors of a leaf, and queries that one task takes to one shard.
SHARD_ROWS = 8192
LEAF_ROWS = 64
WAVE_ROWS = 4096
SEED = 42

# Sums of whole numbers below this are exact as doubles.
EXACT = 2**53

# Stands for a null id inside, so that it loses ties.
NO_ID = 2**63 - 1


def scaled(vector: str | Column) -> Column:
    """floor(1024 x) of every component; what does not fit a long is cut to its range."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def usable(vector: str | Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def _numbers(vectors: np.ndarray, other: np.ndarray) -> type:
    """Doubles where every inner product is exact as such, else Python's whole numbers."""
    dims = vectors.shape[1]
    largest = [max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0 for x in (vectors, other)]
    return float if dims * largest[0] * largest[1] < EXACT else object


class Tree:
    """Median splits of the widest dimension; every node has its tight box and least id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        rows = np.arange(len(ids))
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.least: list[int] = []
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        self._add(rows)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _add(self, rows: np.ndarray) -> int:
        at = len(self.least)
        part = self.vectors[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.least.append(int(self.ids[rows].min()))
        self.children.append(None)
        self.rows.append(rows)
        widths = high.astype(float) - low
        if len(rows) > LEAF_ROWS and len(widths) and widths.max() > 0:
            axis = int(widths.argmax())
            middle = len(rows) // 2
            split = np.argpartition(part[:, axis], middle)
            self.rows[at] = None
            self.children[at] = (self._add(np.sort(rows[split[:middle]])), self._add(np.sort(rows[split[middle:]])))
        return at

    def search(
        self,
        ids: list[int | None],
        queries: np.ndarray,
        k: int,
        known: list[tuple[int, int] | None],
        places: list[int] | None = None,
    ) -> list[list[tuple[int, int]]]:
        """For every query the (score, id) of this shard that can be among its k best.

        ``known`` is the k-th best that another shard has given, or None. Boxes are taken by
        falling bound, the smaller least id first, until none can hold anything better than
        the k-th best known; a bound is the best corner of a box. Rows with a query's id are
        left out, or with ``places`` the row of that place alone.
        """
        kind = _numbers(self.vectors, queries)
        vectors, block = self.vectors.astype(kind), queries.astype(kind)
        none = block * 0
        up, down = np.maximum(block, none), np.minimum(block, none)
        bounds = up @ self.high.astype(kind).T + down @ self.low.astype(kind).T
        return [
            self._best(own, query, bound, vectors, k, kth, place)
            for own, query, bound, kth, place in zip(
                ids, block, bounds, known, places or [None] * len(ids), strict=True
            )
        ]

    def _best(self, own, query, bounds, vectors, k, kth, place=None):
        found: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first
        worst = None if kth is None else (kth[0], -kth[1])
        queue = [(-bounds[0], self.least[0], 0)]
        while queue:
            bound, least, node = heapq.heappop(queue)
            if worst is not None and (-bound, -least) < worst:
                break
            if self.children[node]:
                for child in self.children[node]:
                    entry = (-bounds[child], self.least[child], child)
                    if worst is None or (-entry[0], -entry[1]) >= worst:
                        heapq.heappush(queue, entry)
                continue
            rows = self.rows[node]
            if place is not None:
                rows = rows[rows != place]
            scores = vectors[rows] @ query
            if worst is not None:
                enough = scores >= worst[0]
                rows, scores = rows[enough], scores[enough]
            for score, number in zip(scores.tolist(), self.ids[rows].tolist(), strict=True):
                entry = (int(score), -number)
                if place is None and number == own or worst is not None and entry < worst:
                    continue
                heapq.heappush(found, entry)
                if len(found) > k:
                    heapq.heappop(found)
                if len(found) == k and (worst is None or found[0] > worst):
                    worst = found[0]
        return [(score, -number) for score, number in sorted(found, reverse=True)]


def _limited(score: int) -> int:
    return max(-(2**63), min(2**63 - 1, score))


def _block(vectors: pd.Series, width: int | None = None) -> np.ndarray:
    """Vectors as rows of one width, that of the longest if none is given: cut, or filled with 0."""
    lengths = {len(v) for v in vectors}
    width = max(lengths, default=0) if width is None else width
    if lengths <= {width}:
        return np.array(vectors.tolist(), np.int64).reshape(len(vectors), width)
    block = np.zeros((len(vectors), width), np.int64)
    for row, vector in zip(block, vectors, strict=True):
        row[: len(vector)] = vector[:width]
    return block


def _build(batch: pd.DataFrame) -> pd.DataFrame:
    vectors = _block(batch["vector"])
    tree = Tree(batch["vec_id"].to_numpy(np.int64), vectors)
    shard, dims = int(batch["shard"].iloc[0]), int(batch["dims"].iloc[0])
    return pd.DataFrame({"shard": [shard], "dims": [dims], "tree": [pickle.dumps(tree.__dict__)]})


def _loaded(tree: bytes) -> Tree:
    found = Tree.__new__(Tree)
    found.__dict__ = pickle.loads(tree)
    return found


def trees(vectors: DataFrame, id_column: str, vector_column: str, every_row: bool = False) -> tuple[DataFrame, int]:
    """(shard, dims, tree) with the number of shards; vectors of other lengths are apart.

    With ``every_row`` lengths up to the same power of two are together, and null ids are there.
    Rows are dealt at random, so that no value of any column makes a large shard.
    """
    rows = vectors.where(usable(vector_column))
    if every_row:
        rows = rows.withColumn(id_column, F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)))
    rows = rows.where(F.col(id_column).isNotNull())
    dims = F.size("vector")
    if every_row:
        dims = F.ceil(F.log2(F.greatest(dims, F.lit(1)))).cast("int")
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    dealt = rows.select(
        F.col(id_column).cast("long").alias("vec_id"),
        scaled(vector_column).alias("vector"),
        F.floor(F.rand(SEED) * shards).alias("shard"),
    ).withColumn("dims", dims)
    built = dealt.groupBy("shard", "dims").applyInPandas(_build, "shard long, dims int, tree binary")
    return stored(built, "trees"), shards


QUERY = "row string, query_id long, shard long, dims int, vector array<long>, ids array<long>, scores array<long>"


def _first(built: DataFrame, modulus: int, k: int, every_row: bool) -> DataFrame:
    """Every query with the best of its own shard."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, dims, raw in zip(batch["shard"], batch["dims"], batch["tree"], strict=True):
                tree = _loaded(raw)
                asked = tree.ids % modulus == 0
                if every_row:
                    asked &= tree.ids != NO_ID
                for at in np.array_split(np.flatnonzero(asked), 1 + len(tree.ids) // WAVE_ROWS):
                    if not len(at):
                        continue
                    ids, block = tree.ids[at].tolist(), tree.vectors[at]
                    places = at.tolist() if every_row else None
                    best = tree.search(ids, block, k, [None] * len(ids), places)
                    yield pd.DataFrame(
                        {
                            "row": [f"{shard}-{dims}-{n}" for n in at],
                            "query_id": ids,
                            "shard": shard,
                            "dims": dims,
                            "vector": block.tolist(),
                            "ids": [[n for _, n in found] for found in best],
                            "scores": [[_limited(s) for s, _ in found] for found in best],
                        }
                    )

    return built.mapInPandas(search, QUERY)


def _elsewhere(queries: pd.DataFrame, built: pd.DataFrame, k: int, every_row: bool) -> pd.DataFrame:
    """The best that one shard adds to a wave of queries of other shards."""
    rows: list[tuple] = []
    if len(queries) and len(built):
        tree = _loaded(built["tree"].iloc[0])
        block = _block(queries["vector"], tree.vectors.shape[1])
        known = [
            (int(scores[k - 1]), int(ids[k - 1])) if len(ids) >= k else None
            for ids, scores in zip(queries["ids"], queries["scores"], strict=True)
        ]
        own = queries["query_id"].tolist()
        # In another shard no place is the query's own.
        places = [-1] * len(own) if every_row else None
        for row, number, found in zip(queries["row"], own, tree.search(own, block, k, known, places), strict=True):
            rows += [(row, number, other, _limited(score)) for score, other in found]
    return pd.DataFrame(rows, columns=["row", "query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame,
    modulus: int = 100,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    every_row: bool = False,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query.

    Queries are the rows whose id is divisible by ``modulus``; candidates are all rows with
    another id. Vectors are compared as whole numbers, floor(1024 x), and with vectors of the
    same length only, so empty ones with empty ones at 0. Equal scores go to the smaller id.
    Null vectors, those that hold a null or a component that is not finite, and null ids take
    no part. Rows that repeat an id are candidates of their own, and queries of their own that
    give equal rows. Scores beyond a long are cut to its range. Fewer than k candidates give
    as many rows; an empty table gives none.

    With ``every_row`` candidates are all rows but the query's own: also those that repeat its
    id, those without an id, which come last among equal scores, and vectors of other lengths,
    where a missing component counts as 0.

    A query is first searched in its own shard. Its k-th best from there goes with it to all
    other shards, where boxes that cannot hold better are left out. A task holds one shard
    and a wave of some thousand queries.
    """
    built, shards = trees(vectors, id_column, vector_column, every_row)
    queries = stored(_first(built, modulus, k, every_row), "queries")
    waves = max(1, -(-queries.count() // WAVE_ROWS))
    wave = F.pmod(F.xxhash64("row"), F.lit(waves))
    sent = queries.withColumn("wave", wave).withColumn("target", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    others = F.col("target") != F.col("shard")
    if every_row:
        sizes = sorted(r[0] for r in built.select("dims").distinct().collect())
        sent = sent.withColumn("size", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")))
        others = others | (F.col("size") != F.col("dims"))
        sent = sent.where(others).withColumn("dims", F.col("size"))
    else:
        sent = sent.where(others)
    sent = sent.select("target", "dims", "wave", "row", "query_id", "vector", "ids", "scores")
    there = built.withColumnRenamed("shard", "target").withColumn(
        "wave", F.explode(F.sequence(F.lit(0), F.lit(waves - 1)))
    )
    keys = ["target", "dims", "wave"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _elsewhere(left, right, k, every_row)

    added = sent.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInPandas(
        search, "row string, query_id long, vec_id long, score long"
    )
    near = queries.select("row", "query_id", F.explode(F.arrays_zip("ids", "scores")).alias("f"))
    near = near.select("row", "query_id", F.col("f.ids").alias("vec_id"), F.col("f.scores").alias("score"))
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.unionByName(added).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    if every_row:
        ranked = ranked.withColumn("vec_id", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")))
    return ranked.select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
