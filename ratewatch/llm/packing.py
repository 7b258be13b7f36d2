"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.llm.text import numbered, word_count
from ratewatch.session import stored

CAPACITIES = (512, 1024, 2048, 4096)

# The price of a sequence of length c is c + FIXED + c * c / QUADRATIC: every position, what
# any sequence costs, and attention. The last makes long sequences dearer a position.
FIXED = 64
QUADRATIC = 65536

# Pieces that one task packs.
SHARD_ROWS = 8192


def price(capacity: int) -> float:
    return capacity + FIXED + capacity * capacity / QUADRATIC


def smallest(capacities: Sequence[int], size: int) -> int:
    """The least permitted capacity that holds a size."""
    return capacities[bisect_left(capacities, size)]


def fill(sizes: Sequence[int], falling: Sequence[int], at: int, room: int) -> int:
    """What pieces behind a place, the largest that fits first, could put into a room.

    ``falling`` holds the sizes negated, in which they ascend.
    """
    used = 0
    while room > used:
        at = bisect_left(falling, used - room, at)
        if at == len(sizes):
            break
        used += sizes[at]
        at += 1
    return used


def opening(sizes: Sequence[int], falling: Sequence[int], at: int, capacities: Sequence[int]) -> int:
    """The permitted length with the least price a position, once the pieces to come are in it.

    A length counts as what it could be downsized to; the smaller one where two cost the same.
    """
    best = None
    for capacity in capacities[bisect_left(capacities, sizes[at]) :]:
        held = sizes[at] + fill(sizes, falling, at + 1, capacity - sizes[at])
        cost = price(smallest(capacities, held)) / held
        if best is None or cost < best[0]:
            best = (cost, capacity)
    return best[1]


def best_fit(sizes: Sequence[int], capacities: Sequence[int], opened: int | None) -> list[int]:
    """The bin of every size, given in descending order.

    A size goes where it leaves least room. Where no bin has room for it, the least-cost
    length is opened; with ``opened`` it is that one, or the least that holds the size.
    """
    falling = [-size for size in sizes]
    room: list[tuple[int, int]] = []
    chosen = []
    bins = 0
    for place, size in enumerate(sizes):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, number = room.pop(at)
        else:
            left = opening(sizes, falling, place, capacities) if opened is None else max(opened, smallest(capacities, size))
            number = bins
            bins += 1
        chosen.append(number)
        if left > size:
            insort(room, (left - size, number))
    return chosen


def filled(sizes: Sequence[int], chosen: Sequence[int]) -> dict[int, int]:
    contents: dict[int, int] = {}
    for size, number in zip(sizes, chosen, strict=True):
        contents[number] = contents.get(number, 0) + size
    return contents


def packed(sizes: Sequence[int], capacities: Sequence[int]) -> tuple[list[int], dict[int, int]]:
    """The packing that opens the least-cost length each time, and its capacities.

    It is priced after its bins have been downsized to what they hold, and so are packings
    that open one length throughout; one of these is taken only where it is cheaper.
    """
    best: tuple[float, list[int], dict[int, int]] | None = None
    for opened in (None, *capacities):
        chosen = best_fit(sizes, capacities, opened)
        bins = {n: smallest(capacities, held) for n, held in filled(sizes, chosen).items()}
        cost = sum(map(price, bins.values()))
        if best is None or cost < best[0]:
            best = (cost, chosen, bins)
    return best[1], best[2]


def pieces(docs: DataFrame, size: Column, most: int) -> DataFrame:
    """(doc_id, key, start, length): documents cut into pieces of ``most`` and a rest."""
    sized = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), size.cast("long").alias("size"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(most).cast("long"))
    cut = sized.where("size > 0").select("doc_id", "key", "size", F.explode(starts).alias("start"))
    return cut.select("doc_id", "key", "start", F.least(F.lit(most), F.col("size") - F.col("start")).alias("length"))


def pack(docs: DataFrame, size: Column | None = None, capacities: Sequence[int] = CAPACITIES) -> DataFrame:
    """(doc_id, start, length, bin, place, capacity): every piece of a document and its place.

    The size is the number of words and one for the end, unless another is given; null or 0
    takes no place and gives no row. A document longer than the largest capacity is cut into
    full pieces and a rest, so no word is lost. Pieces are dealt to shards of some thousands
    by hash, whatever their source or size, and every shard is packed by itself: at most one
    poorly filled bin for each size class and shard. Ties are broken by the hash of id and
    text, so reruns agree; rows that repeat both share the hash and are packed each. ``bin``
    is unique, ``place`` the first position in it. An empty table gives no rows.
    """
    sizes = tuple(sorted(set(capacities)))
    cut = stored(pieces(docs, word_count("text") + 1 if size is None else size, sizes[-1]), "pieces")
    full = cut.where(F.col("length") == sizes[-1])
    rest = cut.where(F.col("length") < sizes[-1])
    shards = -(-rest.count() // SHARD_ROWS) or 1

    def solve(batch: pd.DataFrame) -> pd.DataFrame:
        rows = batch.sort_values(["length", "key", "start"], ascending=[False, True, True], kind="stable")
        chosen, bins = packed(rows["length"].tolist(), sizes)
        number = pd.Series(chosen, index=rows.index)
        place = rows["length"].groupby(number).cumsum() - rows["length"]
        name = [f"{shard}-{n}" for shard, n in zip(rows["shard"], number, strict=True)]
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"],
                "start": rows["start"],
                "length": rows["length"],
                "bin": name,
                "place": place,
                "capacity": number.map(bins),
            }
        )

    kind = "doc_id long, start long, length long, bin string, place long, capacity long"
    shard = F.pmod(F.xxhash64("key", "start"), F.lit(shards))
    together = rest.withColumn("shard", shard).groupBy("shard").applyInPandas(solve, kind)
    own = F.concat_ws("-", F.lit("full"), F.hex("key"), "start", "number")
    alone = numbered(full, ("key", "start"), SHARD_ROWS).select(
        "doc_id",
        "start",
        "length",
        own.alias("bin"),
        F.lit(0).cast("long").alias("place"),
        F.lit(sizes[-1]).cast("long").alias("capacity"),
    )
    return alone.unionByName(together)
