"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ratewatch.session import forget, stored


def _written(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    """The links in the shared folder, and their number and a digest, taken as they are written."""
    seen = Observation()
    digest = F.bit_xor(F.xxhash64("low", "high")).alias("digest")
    kept = stored(pairs.observe(seen, F.count(F.lit(1)).alias("n"), digest), "links")
    return kept, (seen.get["n"], seen.get["digest"])


def _large_star(pairs: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = pairs.select(F.col("low").alias("node"), F.col("high").alias("near")).unionAll(
        pairs.select(F.col("high").alias("node"), F.col("low").alias("near"))
    )
    least = both.groupBy("node").agg(F.min("near").alias("least"))
    joined = both.where("near > node").join(least, "node")
    return joined.select(F.least("node", "least").alias("low"), F.col("near").alias("high"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = pairs.groupBy("high").agg(F.min("low").alias("least"))
    joined = pairs.join(least, "high")
    other = F.when(F.col("low") == F.col("least"), F.col("high")).otherwise(F.col("low"))
    return joined.select(F.col("least").alias("low"), other.alias("high")).where("low < high").distinct()


def connected(links: DataFrame) -> DataFrame:
    """The component of every node that has a link.

    ``links`` has two columns of one type that can be compared; nulls and links of a node to
    itself are left out. Gives (node, component), where the component is its least node. Each
    round works on all links by grouping and joining, is written to the shared folder, and
    only a count and a digest of the links come to the driver. No links: no rows.
    """
    a, b = links.columns
    proper = links.where(F.col(a) != F.col(b))
    pairs = proper.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
    pairs, digest = _written(pairs.distinct())
    while digest[0]:
        before, last = digest, pairs
        pairs, digest = _written(_small_star(_large_star(last)))
        forget(last)
        if digest == before:
            break
    members = pairs.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return members.unionAll(pairs.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())
