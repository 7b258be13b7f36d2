"""Mixing sources to target weights by pivotal rounding of copy numbers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewatch.llm.text import numbered, word_count
from ratewatch.session import stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_COPIES = 2.0
SEED = 42

# Documents that one task pairs, and residuals that one task combines.
LEAF_ROWS = 4096
FAN_IN = 256
# Documents meet others of similar size: this many size classes for each doubling.
CLASSES = 8


def targets(sizes: DataFrame, share: float = SHARE, most: float = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Weights repeat over the sources in order of code points, null last. A source stops at
    ``most`` times its size and the others share what is left by weight: all grow along one
    level, which is found by sorting the sources by the level at which they stop. Only the
    table of sources, one row each, is ordered as a whole.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), turn + 1)
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    by_stop = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("capped", F.coalesce(F.sum("cap").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("passed", F.coalesce(F.sum("weight").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    )
    level = (F.col("total") - F.col("capped")) / (F.col("weights") - F.col("passed"))
    stops = F.col("cap") <= level * F.col("weight")
    rows = rows.withColumn("level", F.when(~stops, level))
    # The first source that does not stop gives the level; behind it too much is taken off.
    rows = rows.withColumn("level", F.max("level").over(everything))
    amount = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return rows.select("source", "source_size", amount.cast("double").alias("target"))


def uniform(seed: int, *keys: object) -> float:
    """A number in [0, 1) that depends on the keys only."""
    return xxhash.xxh64_intdigest(repr(keys).encode(), seed) / 2.0**64


def pivot(parts: list[list], seed: int) -> None:
    """Make all but one of the fractions integral, in place; a part is [key, size, fraction].

    Two fractions exchange mass, so that the words they stand for stay the same, until one of
    them is 0 or 1; which way is random, with the probability that keeps each expected value.
    """
    open_at: int | None = None
    for at, (key, size, fraction) in enumerate(parts):
        if fraction in (0.0, 1.0):
            continue
        if open_at is None:
            open_at = at
            continue
        other, other_size, other_fraction = parts[open_at]
        up = min((1 - other_fraction) * other_size, fraction * size)
        down = min(other_fraction * other_size, (1 - fraction) * size)
        if uniform(seed, other, key) * (up + down) < down:
            full, empty = (1 - other_fraction) * other_size <= up, fraction * size <= up
            a = 1.0 if full else other_fraction + up / other_size
            b = 0.0 if empty else fraction - up / size
        else:
            full, empty = (1 - fraction) * size <= down, other_fraction * other_size <= down
            a = 0.0 if empty else other_fraction - down / other_size
            b = 1.0 if full else fraction + down / size
        parts[open_at][2], parts[at][2] = a, b
        if a in (0.0, 1.0):
            open_at = None if b in (0.0, 1.0) else at


def settle(parts: list[list], seed: int) -> None:
    """Draw the last fractions, in place and in the order given.

    The words that a draw adds or leaves out are taken from or given to the parts after it,
    so that what remains at the end is about the size of the last ones.
    """
    owed = 0.0
    for part in parts:
        key, size, fraction = part
        chance = min(1.0, max(0.0, fraction + owed / size))
        part[2] = float(uniform(seed, key) < chance)
        owed += (fraction - part[2]) * size


def _rounded(rows: DataFrame, group: list[str], step: Callable[[list[list], int], None]) -> DataFrame:
    """Round the fractions of every group by ``step``, largest document first."""

    def solve(batch: pd.DataFrame) -> pd.DataFrame:
        ordered = batch.sort_values(["size", "key"], ascending=[False, True], kind="stable").copy()
        parts = [list(x) for x in zip(ordered["key"], ordered["size"], ordered["fraction"], strict=True)]
        step(parts, SEED)
        return ordered.assign(key=[p[0] for p in parts], fraction=[float(p[2]) for p in parts])

    return rows.groupBy(*group).applyInPandas(solve, rows.schema)


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    whole = F.col("fraction").isin(0.0, 1.0)
    return rows.where(whole), rows.where(~whole)


def rounded(parts: DataFrame) -> DataFrame:
    """(key, extra): the rounded fraction of every (source_no, key, size, fraction).

    Leaves hold documents of one source and about one size; a large size class is dealt over
    as many leaves as it needs. Each leaf leaves one residual at most. Residuals are combined
    a few hundred at a time, first those of one size class, then those of one source, whose
    classes are bounded in number: the residuals of the classes are drawn, largest first, each
    passing on to the next what it adds or leaves out.
    """
    sized = parts.withColumn("class", F.floor(F.log2(F.col("size")) * CLASSES).cast("int"))
    counts = sized.groupBy("source_no", "class").agg(F.ceil(F.count("*") / LEAF_ROWS).alias("leaves"))
    counts = stored(counts, "leaves")
    widest = counts.agg(F.max("leaves")).first()[0] or 1
    leaf = F.pmod(F.xxhash64("key"), F.col("leaves"))
    dealt = sized.join(counts, ["source_no", "class"]).withColumn("leaf", leaf).drop("leaves")
    rest = stored(_rounded(dealt, ["source_no", "class", "leaf"], pivot), "rounded")
    done = []
    while widest > 1:
        settled, rest = _split(rest)
        done.append(settled)
        rest = rest.withColumn("leaf", F.floor(F.col("leaf") / FAN_IN).cast("long"))
        rest = stored(_rounded(rest, ["source_no", "class", "leaf"], pivot), "rounded")
        widest = -(-widest // FAN_IN)
    settled, rest = _split(rest)
    done.append(settled)
    final = _rounded(rest, ["source_no"], settle)
    for settled in done:
        final = final.unionByName(settled)
    return final.select("key", F.col("fraction").cast("long").alias("extra"))


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with the key of their unit: id, source and text."""
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return docs.withColumn(
        "__key", F.concat_ws(":", number, F.xxhash64("doc_id", "source", "text").cast("string"))
    )


def _shared(parts: DataFrame) -> DataFrame:
    """The words of a unit and the fraction of all its rows' copies that is drawn.

    Rows that repeat id, source and text are one unit of ``rows`` rows. Of its rows * fraction
    copies the whole ones are sure, and the rest is drawn as for a single row.
    """
    total = F.col("rows") * F.col("fraction")
    return parts.withColumn("sure", F.floor(total)).withColumn("fraction", total - F.floor(total))


def mixed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, key, copies) for every document.

    The size is the number of words, 0 for null; such documents are never taken. All
    documents of a source have the same expected number of copies, target / source_size, so
    0 to 2 copies each. The words taken from a source miss its target by about the
    size of its smaller documents. Draws depend on id, source and text
    only, so reruns agree. Rows that repeat all three are equal, and so many of them are taken
    once more than the others as bring them to the target together. A
    null source is a source of its own; an empty table gives no rows.
    """
    rows = _keyed(docs.select("doc_id", "source", "text")).select(
        "doc_id",
        F.xxhash64("source").alias("source_no"),
        "source",
        word_count("text").alias("size"),
        F.col("__key").alias("key"),
    )
    rows = stored(rows, "sizes")
    aims = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = aims.select(F.col("source").alias("name"), "source_size", "target", rate.alias("rate"))
    joined = rows.join(named, rows["source"].eqNullSafe(named["name"])).drop("name", "source")
    whole = F.floor("rate")
    units = joined.where("size > 0").groupBy("source_no", "key", "rate").agg(
        F.first("size").alias("size"), F.count("*").alias("rows")
    )
    units = stored(_shared(units.withColumn("fraction", F.col("rate") - whole)), "units")
    extra = rounded(units.select("source_no", "key", "size", "fraction"))
    # So many rows of the unit have a copy more than the others, the first by number.
    more = units.select(F.col("key").alias("of"), "rows", "sure").join(
        extra.withColumnRenamed("key", "drawn"), F.col("of") == F.col("drawn")
    )
    more = more.select("of", "rows", (F.col("sure") + F.col("extra")).alias("more"))
    known = joined.join(more, joined["key"] == more["of"], "left")
    once = known.where(F.coalesce("rows", F.lit(1)) == 1).withColumn("extra", F.coalesce("more", F.lit(0)))
    several = numbered(known.where("rows > 1"), ("key",), LEAF_ROWS).withColumn("extra", (F.col("number") <= F.col("more")).cast("long")).drop("number")
    taken = once.unionByName(several)
    copies = F.when(F.col("size") > 0, whole + F.col("extra")).otherwise(0).cast("long")
    return taken.withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "key", "copies"
    )


def copied(docs: DataFrame) -> DataFrame:
    """The documents of the mix with their own columns, each as often as it is taken."""
    plan = mixed(docs).where("copies > 0").groupBy("key").agg(
        F.sum("copies").alias("__copies"), F.count("*").alias("__rows")
    )
    plan = stored(plan.withColumnRenamed("key", "__of"), "copies")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    joined = _keyed(docs).join(plan, F.col("__key") == F.col("__of"))
    # Rows that are equal need not be told apart: the first of them stands for all copies.
    single = joined.where("__rows = 1")
    repeats = joined.where("__rows > 1").dropDuplicates(["__key"])
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__again")
    return single.unionByName(repeats).select(*columns, again).drop("__again")
