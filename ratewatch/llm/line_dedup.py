"""Line dedup with DataFrame functions only: MinHash bands, exact Jaccard, components."""

from __future__ import annotations

import random
from collections import Counter
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewatch.llm.components import connected
from ratewatch.llm.text import WORD, with_text
from ratewatch.session import forget, stored

# Characters of a shingle, and the share of shingles that makes two lines the same: 4 of 5.
SHINGLE_CHARS = 5
SIMILAR_PARTS, PARTS = 4, 5

# Hashes of a shingle, and orders of the shingles that each of them gives.
HASHES = 8
ROWS = 4

# Shingles of a line that are hashed in one row, and hashes that one number gives by turning it.
BLOCK = 16
TURNS = 4

# Minima of a signature.
ORDERS = HASHES * ROWS

# Masks that turn one hash into several orders: each has another quarter of all 64-bit
# numbers come first.
MASKS = [(0x1E3779B97F4A7C15 + (k << 62)) - (1 << 63) for k in range(ROWS)]

# Minima of a pair of a band that have to agree, by their last bytes, before its texts are
# compared. Two lines that share 0.8 of their shingles have fewer with probability 0.0006.
AGREEING = 18


def _spread(bands: int, size: int, orders: int, tries: int = 100) -> list[tuple[int, ...]]:
    """Sets of ``size`` of the orders that have as few pairs in common as a search finds."""
    draw, used, sets = random.Random(0), Counter(), []
    for _ in range(bands):
        drawn = [tuple(sorted(draw.sample(range(orders), size))) for _ in range(tries)]
        best = min(drawn, key=lambda x: 2 * sum(used[p] for p in combinations(x, 2)) + sum(used[k] for k in x))
        used.update([*best, *combinations(best, 2)])
        sets.append(best)
    return sets


# The minima of each band: five, as lines that share a third of their shingles by chance, as long
# lines of one language do, would meet in bands of three, the more the more lines there are. Two
# lines that share 0.8 of their shingles meet in a band with probability 0.997, those that share
# 0.85 with 0.9997.
SETS = _spread(28, 5, ORDERS)

# Bands whose keys are shuffled at once.
AT_ONCE = 7

# Lines of a bucket up to which they are all compared with each other. The lines of larger
# buckets get further signatures instead, and of the sum of minima that agree in two
# signatures pairs with 0.8 have fewer with probability 0.001.
FEW = 256
FURTHER = 3
AGREEING_IN_TWO = 41

# Finer bands of a further signature, of eight of its minima each. Two lines that share 0.8
# meet in one of the 60 with probability 0.998, two that share 0.5 with 0.2.
FINE_SETS = _spread(20, 8, ORDERS)

# Lines up to which those of a finer bucket are all compared: more than by chance share their
# shingles there, and are told apart by their rarest ones.
FINE_FEW = 32

# Pairs of one line that a task compares.
SHARE = 1024

# Words of 64 bits in which the numbers of wanted lines are marked, at the most.
WORDS = 1 << 18


def _encoded(line: str, size: int = SHINGLE_CHARS) -> Column:
    """A line as units of UTF-16, filled up to ``size`` of them at the least."""
    return F.encode(F.rpad(line, F.greatest(F.char_length(line), F.lit(size)), "\n"), "UTF-16BE")


def shingles(line: str, size: int = SHINGLE_CHARS) -> Column:
    """Hashes of all runs of ``size`` characters, with repeats; a shorter line is its own shingle.

    Characters are units of UTF-16, in which a run is cut out of a line at its place without
    a search from the line's start. The encoded line is bound to a lambda's variable.
    """
    encoded = F.array(_encoded(line, size))
    runs = F.transform(
        encoded,
        lambda e: F.transform(
            F.sequence(F.lit(1), F.octet_length(e) - (2 * size - 1), F.lit(2)),
            lambda i: F.xxhash64(F.substring(e, i, F.lit(2 * size))),
        ),
    )
    return F.element_at(runs, 1)


def lines_of(docs: DataFrame) -> DataFrame:
    """One row a line with a word: its document, position and two hashes of its text."""
    split = docs.select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n")))
    lines = split.withColumnsRenamed({"col": "line"}).where(F.col("line").rlike(WORD))
    return lines.withColumn("near", F.xxhash64("line")).withColumn("same", _same("line"))


def _same(line: str) -> Column:
    return F.unhex(F.md5(line))


def signatures(lines: DataFrame, seeds: range = range(1)) -> DataFrame:
    """(near, same, seed, copies, s0, s1, ...): minima of the hashes of all shingles of a line in several orders.

    Every seed gives a line another signature; ``copies`` is how often the line is there.

    Shingles are taken BLOCK at a time, the last one again where a line has no more, and of the
    hashes of a block the least in each order goes on. A hash is turned by quarters of its bits to
    give several, whose first bits decide their orders, and each of these has several masks. Lines
    are bound by ``inline``, so that they are encoded once, and aggregated where they arise, so that
    one row a line is shuffled. ``same`` is grouped as two numbers, for which Spark has a faster map
    than for bytes.
    """
    high, low = (F.conv(F.hex(F.substring("same", k, 8)), 16, -10).cast("long") for k in (1, 9))
    bound = lines.select(F.inline(F.array(F.struct("near", high.alias("high"), low.alias("low"), _encoded("line").alias("e")))))
    line = ["near", "high", "low", "seed"]
    seeded = bound.withColumn("seed", F.explode(F.array(*map(F.lit, seeds))) if len(seeds) > 1 else F.lit(seeds[0]))
    placed = seeded.select(*line, "e", (F.shiftright(F.octet_length("e"), 1) - SHINGLE_CHARS).alias("last"))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(BLOCK))).alias("i"))
    starts = [F.least(F.col("i") + j, F.col("last")) * 2 + 1 for j in range(BLOCK)]
    runs = [F.xxhash64(F.substring("e", start, F.lit(2 * SHINGLE_CHARS))).alias(f"h{j}") for j, start in enumerate(starts)]
    hashed = placed.select(*line, (F.col("i") == 0).cast("long").alias("start"), *runs)
    calls = range(HASHES // TURNS)
    again = [F.xxhash64(F.lit(c) + len(calls) * F.col("seed"), f"h{j}").alias(f"g{c}_{j}") for c in calls for j in range(BLOCK)]
    words = hashed.select(*line, "start", *again)
    least = []
    for b in range(HASHES):
        turned = [_turned(f"g{b // TURNS}_{j}", 64 // TURNS * (b % TURNS)) for j in range(BLOCK)]
        for r in range(ROWS):
            ordered = [h.bitwiseXOR(F.lit(MASKS[r])) for h in turned]
            least.append(F.min(F.least(*ordered)).alias(f"s{b * ROWS + r}"))
    same = F.unhex(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in ("high", "low")])).alias("same")
    found = words.groupBy(*line).agg(F.sum("start").alias("copies"), *least)
    return found.select("near", same, "seed", "copies", *[f"s{k}" for k in range(ORDERS)])


def _turned(h: str, bits: int) -> Column:
    """A 64-bit number with its bits turned to the left."""
    return F.shiftleft(h, bits).bitwiseOR(F.shiftrightunsigned(h, 64 - bits)) if bits else F.col(h)


def sketch(pairs: list[Column] | None = None) -> Column:
    """The last byte of every minimum, of the columns of minima or of these as ``packed`` pairs them."""
    ends, longs = F.lit(0xFF000000FF), []
    pairs = pairs or packed()
    for start in range(0, len(pairs), 4):
        held = [F.shiftleft(x.bitwiseAND(ends), 8 * k) for k, x in enumerate(pairs[start : start + 4])]
        longs.append(reduce(Column.bitwiseOR, held).alias(f"t{len(longs)}"))
    return F.struct(*longs)


def agreeing(a: Column, b: Column) -> Column:
    """How many bytes of two sketches are the same."""
    same = F.lit(ORDERS)
    for k in range(-(-ORDERS // 8)):
        apart = a[f"t{k}"].bitwiseXOR(b[f"t{k}"])
        # The last bit of every byte that is not 0.
        for bits, each in ((4, 0x0F), (2, 0x03), (1, 0x01)):
            apart = apart.bitwiseOR(F.shiftrightunsigned(apart, bits)).bitwiseAND(F.lit(each * 0x0101010101010101))
        same = same - F.bit_count(apart)
    return same


def agree(a: Column, b: Column) -> Column:
    """Whether enough bytes of two sketches are the same."""
    return agreeing(a, b) >= AGREEING


def packed() -> list[Column]:
    """The last halves of the minima, two to a number."""
    low = F.lit((1 << 32) - 1)
    return [F.shiftleft(f"s{k}", 32).bitwiseOR(F.col(f"s{k + 1}").bitwiseAND(low)).alias(f"p{k // 2}") for k in range(0, ORDERS, 2)]


def pairs_of() -> list[Column]:
    """The columns of ``packed``."""
    return [F.col(f"p{k}") for k in range(ORDERS // 2)]


def keyed(held: DataFrame, sets: list[tuple[int, ...]], chosen: range) -> DataFrame:
    """(near, key), and ``seed`` where held has it: keys of some of the bands of every signature, of the minima of a band's set."""
    names = ["near", *(["seed"] if "seed" in held.columns else [])]
    seed = F.col("seed") if "seed" in held.columns else F.lit(0)

    def half(k: int) -> Column:
        return F.col(f"p{k // 2}").bitwiseAND(F.lit((1 << 32) - 1)) if k % 2 else F.shiftright(f"p{k // 2}", 32)

    keys = [F.xxhash64(F.lit(b) + len(sets) * seed, *[half(k) for k in sets[b]]) for b in chosen]
    return held.select(*names, F.explode(F.array(*keys)).alias("key"))


def buckets(held: DataFrame, sets: list[tuple[int, ...]]) -> list[DataFrame]:
    """(key, near, first, n), and ``seed`` where held has it: lines that share a key, its least line and their number.

    Most keys are those of one line. They are shuffled with a number for the line alone, some bands
    at a time. Of two lines of a key only the greater is given, as the other is ``first``.
    """
    shared, of_key = [], Window.partitionBy("key")
    for start in range(0, len(sets), AT_ONCE):
        keys = keyed(held, sets, range(start, min(start + AT_ONCE, len(sets)))).repartition("key")
        rows = keys.select("*", F.min("near").over(of_key).alias("first"), F.count("*").over(of_key).alias("n"))
        shared.append(stored(rows.where("n > 2 or near > first"), "shared"))
    return shared


def members(signed: DataFrame, sets: list[tuple[int, ...]] = SETS) -> DataFrame:
    """(key, near, same, sketch, first, n): lines of ``buckets`` with what else is known of them and of the least line.

    Of a minimum the last half is kept. Two lines with one number or key would be in each
    other's buckets, where comparing tells them apart.
    """
    known = ["near", "same", "seed", *(["both"] if "both" in signed.columns else [])]
    held = stored(signed.select(*known, *packed()), "keyed", plain=True)
    shared = buckets(held, sets)
    shown = F.col("both") if "both" in held.columns else sketch(pairs_of())
    lines = held.select("near", "same", "seed", shown.alias("sketch"))
    least = lines.select(F.col("near").alias("first"), "seed", F.struct("near", "same", "sketch").alias("least"))
    rows = reduce(DataFrame.unionAll, shared).join(lines.hint("shuffle_hash"), ["near", "seed"])
    rows = rows.join(least.hint("shuffle_hash"), ["first", "seed"])
    found = stored(rows.select("key", "near", "same", "sketch", F.col("least").alias("first"), "n"), "members")
    forget(held, *shared)
    return found


def mixed(found: DataFrame, groups: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(key, component, line, sketch): the lines of buckets that hold several components.

    Which buckets these are is found from keys and hashes of components alone. ``known`` has
    (near, same, sketch) of lines where ``found`` has only their key and ``near``.
    """
    part = F.coalesce("component", "same")
    alone = found if known is None else found.join(known.select("near", "same").hint("shuffle_hash"), "near")
    named = alone.select("key", "same").join(groups.hint("shuffle_hash"), F.col("same") == groups["node"], "left")
    named = named.select("key", F.xxhash64(part).alias("part"))
    ends = named.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    several = stored(ends.where("low <> high").select("key"), "several")
    rows = found.join(several.hint("shuffle_hash"), "key", "left_semi")
    rows = rows if known is None else rows.join(known.hint("shuffle_hash"), "near")
    rows = rows.select("key", "near", "same", "sketch").join(groups.hint("shuffle_hash"), F.col("same") == groups["node"], "left")
    line = F.struct("near", "same").alias("line")
    rows = stored(rows.select("key", part.alias("component"), line, "sketch"), "mixed")
    forget(several)
    return rows


def standing(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The number ``m`` of lines of every bucket, and all lines with that of theirs."""
    counts = stored(rows.groupBy("key").agg(F.count("*").alias("m")), "standing")
    return counts, rows.join(counts.hint("shuffle_hash"), "key")


def _ends(pairs: DataFrame) -> DataFrame:
    """(first, a, near, b, component, apart) of pairs of lines, each once."""
    ends = pairs.select(
        F.least("line", "other").alias("low"),
        F.greatest("line", "other").alias("high"),
        F.least("component", "apart").alias("component"),
        F.greatest("component", "apart").alias("apart"),
    )
    return ends.select(
        F.col("low.near").alias("first"),
        F.col("low.same").alias("a"),
        F.col("high.near").alias("near"),
        F.col("high.same").alias("b"),
        "component",
        "apart",
    ).distinct()


def few_pairs(apart: DataFrame, alike: Column, most: int | None = None) -> DataFrame:
    """Pairs of buckets with few lines (FEW, or ``most``): all of different components with each other."""
    few = apart.where(F.col("m") <= (most or FEW)).select("key", "line", "sketch", "component")
    other = few.toDF("key", "other", "against", "apart")
    pairs = few.join(other, "key").where((F.col("component") < F.col("apart")) & alike)
    return _ends(pairs.select("line", "component", "other", "apart"))


def rarest(texts: DataFrame) -> DataFrame:
    """(id, h, place, n, before): the fifth of a line's n different shingles that fewest lines have, and one more.

    Two lines that are similar share one of these: what one of them has beside the shared
    shingles is at most a fifth of its own. ``place`` is that in the line's order, from 1, and
    ``before`` are those that come before it. Shingles that no other line has take the first
    places and are not given.
    """
    held = texts.select("id", F.explode(F.array_distinct(shingles("line"))).alias("h"))
    held = held.select("h", "id")
    lines = held.groupBy("h").agg(F.count("*").alias("lines")).where("lines > 1")
    shared = held.join(lines.hint("shuffle_hash"), "h")
    order = Window.partitionBy("id").orderBy("lines", "h")
    ranked = shared.select(
        "id", "h", "lines", F.row_number().over(order).alias("rank"), F.count("*").over(Window.partitionBy("id")).alias("several")
    )
    ranked = ranked.join(texts.select("id", "n").hint("shuffle_hash"), "id")
    place = (F.col("n") - F.col("several") + F.col("rank")).cast("int")
    placed = ranked.select("id", "h", "lines", place.alias("place"), "n")
    placed = placed.where(F.col("place") <= F.floor(F.col("n") * (PARTS - SIMILAR_PARTS) / PARTS) + 1)
    before = F.collect_list("h").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return placed.select("id", "h", "place", "n", before.alias("before"))


def clusters(rows: DataFrame) -> DataFrame:
    """(line, cluster): lines of buckets that hang together by lines in both are one cluster."""
    least = rows.groupBy("line").agg(F.min("key").alias("least"))
    ends = stored(rows.select("key", "line").join(least.hint("shuffle_hash"), "line").select("least", "key").distinct(), "ends")
    joined = stored(connected(ends), "hung")
    least = rows.groupBy("line").agg(F.min("key").alias("node"))
    named = least.join(joined, "node", "left").select("line", F.coalesce("component", "node").alias("cluster"))
    named = stored(named, "clusters")
    forget(ends, joined)
    return named


def many_pairs(lines: DataFrame, apart: DataFrame, few: int | None = None) -> DataFrame:
    """Pairs of buckets with too many lines for ``few_pairs``, of different components.

    Lines of a cluster of buckets are paired where they share one of their ``rarest`` shingles
    and, from there on, have enough left that may be shared, which leaves out no similar pair.
    This is looked at where they share the first one. In each of these places the lines of the
    component with most are not paired with each other. A line comes once, in however many
    buckets it is.
    """
    rows = stored(apart.where(F.col("m") > (few or FEW)).drop("m"), "large")
    hung = clusters(rows)
    wanted = rows.select("line", "sketch", "component").groupBy("line").agg(
        F.first("sketch").alias("sketch"), F.first("component").alias("component")
    )
    line = F.struct("near", "same")
    known = lines.select(line.alias("line"), F.col("line").alias("text"))
    texts = known.join(wanted.hint("shuffle_hash"), "line").groupBy("line").agg(
        F.first("text").alias("text"), F.first("sketch").alias("sketch"), F.first("component").alias("component")
    )
    texts = texts.select(F.col("line").alias("named"), F.col("text").alias("line"), "sketch", "component")
    texts = evenly(texts, "named").withColumn("n", F.size(F.array_distinct(shingles("line"))))
    texts = stored(texts.withColumn("id", F.monotonically_increasing_id()), "texts")
    prefix = stored(rarest(texts), "rarest")
    part = F.xxhash64("component").alias("part")
    ids = texts.select(F.col("named").alias("line"), "id", part)
    buckets = hung.join(ids.hint("shuffle_hash"), "line").select("cluster", "id", "part")
    met = prefix.join(buckets.hint("shuffle_hash"), "id").select(
        F.xxhash64("cluster", "h").alias("spot"), "id", "part", "place", "n", "before"
    )
    met = stored(met, "met")
    most = met.groupBy("spot", "part").agg(F.count("*").alias("c")).groupBy("spot")
    most = most.agg(F.max_by("part", F.struct("c", "part")).alias("most"), F.count("*").alias("parts")).where("parts > 1")
    spots = stored(met.join(most.hint("shuffle_hash"), "spot").drop("parts"), "spots")
    one = spots.where("part <> most")
    two = spots.select("spot", *[F.col(c).alias(f"{c}2") for c in ("id", "part", "place", "n", "before")])
    left = 1 + F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    enough = (left * (PARTS + SIMILAR_PARTS) >= (F.col("n") + F.col("n2")) * SIMILAR_PARTS) & (
        F.least("n", "n2") * PARTS >= F.greatest("n", "n2") * SIMILAR_PARTS
    )
    once = (F.col("part") != F.col("part2")) & ((F.col("part2") == F.col("most")) | (F.col("id") < F.col("id2")))
    first = ~F.arrays_overlap("before", "before2")
    ends = one.join(two, "spot").where(once & enough & first).select(
        F.least("id", "id2").alias("id"), F.greatest("id", "id2").alias("id2")
    )
    ends = stored(ends, "ends")
    sides = texts.select("id", F.col("named").alias("line"), "component", "sketch")
    pairs = ends.join(sides, "id").join(sides.toDF("id2", "other", "apart", "against"), "id2")
    pairs = pairs.where(agree(F.col("sketch"), F.col("against")))
    pairs = stored(_ends(pairs.select("line", "component", "other", "apart")), "many")
    forget(rows, hung, texts, prefix, met, spots, ends)
    return pairs


def regrouped(groups: DataFrame, across: DataFrame) -> DataFrame:
    """(node, component) of ``groups`` with what links (component, apart) join."""
    joined = connected(across.select("component", "apart").distinct())
    joined = stored(joined.select(F.col("node").alias("part"), F.col("component").alias("whole")), "joined")
    every = groups.join(joined, groups["component"] == joined["part"], "left")
    known = every.select("node", F.coalesce("whole", "component").alias("component"))
    # A part that was a lone line is in no star.
    lone = joined.join(groups, joined["part"] == groups["node"], "left_anti")
    return known.unionAll(lone.select("part", "whole"))


def further_pairs(lines: DataFrame, found: DataFrame, apart: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs among the lines of buckets with too many lines for ``few_pairs``.

    Such lines share what brought them together, so their buckets do not tell them apart. They
    get FURTHER more signatures with bands of more minima, which also follow what only some of
    them share. There, lines are compared with the least line of their bucket and then all lines
    of different components with each other again, in a bucket of many by ``many_pairs``. Two
    signatures together, the first and the further one, have to agree before texts are compared.
    Links to least lines are among the pairs; a component that these join has the least of the
    joined ones' names in other pairs.
    """
    large = apart.where(F.col("m") > FEW).select("key").distinct()
    many = found.join(large, "key").select(F.col("line.near").alias("n"), F.col("line.same").alias("s"), "sketch")
    many = stored(many.groupBy("n", "s").agg(F.first("sketch").alias("before")), "many")
    known = lines.join(many.hint("shuffle_hash"), (lines["near"] == many["n"]) & (lines["same"] == many["s"]))
    texts = known.select("near", "same", "line").distinct()
    signed = signatures(texts, range(1, 1 + FURTHER))
    signed = signed.join(many.hint("shuffle_hash"), (signed["near"] == many["n"]) & (signed["same"] == many["s"]))
    held = signed.withColumn("both", F.struct(F.col("before"), sketch().alias("now"))).drop("before", "n", "s")
    finer = members(held, FINE_SETS)

    def alike(one: str, two: str) -> Column:
        before, now = (agreeing(F.col(f"{one}.{s}"), F.col(f"{two}.{s}")) for s in ("before", "now"))
        return before + now >= AGREEING_IN_TWO

    # First, as before, the least line of every bucket with the others.
    near = finer.where((F.col("same") != F.col("first.same")) & alike("sketch", "first.sketch"))
    near = near.select(F.struct("near", "same").alias("line"), F.struct("first.near", "first.same").alias("other")).distinct()
    near = near.join(groups.toDF("node", "component").hint("shuffle_hash"), F.col("line.same") == F.col("node"), "left")
    near = near.withColumn("component", F.coalesce("component", "line.same")).drop("node")
    near = near.join(groups.toDF("node", "apart").hint("shuffle_hash"), F.col("other.same") == F.col("node"), "left")
    near = near.withColumn("apart", F.coalesce("apart", "other.same")).drop("node").where("component <> apart")
    near = stored(_ends(near).withColumns({"low": F.col("first"), "high": F.col("near")}), "near")
    links = verified(texts, near)
    one = F.struct(F.col("low").alias("first"), "a", F.col("high").alias("near"), "b").alias("one")
    stars = stored(links.select(one, "component", "apart").groupBy("component", "apart").agg(F.min("one").alias("one")), "fine-stars")
    forget(near, links)
    groups = stored(regrouped(groups, stars), "groups-again")
    rest = mixed(finer.where("n > 2"), groups)
    forget(finer)
    chosen, again = standing(rest)

    # A line has a further sketch for every seed, and one of the first signature.
    found = stars.select("one.*", "component", "apart")
    few = min(FEW, FINE_FEW)
    pairs = few_pairs(again, alike("sketch", "against"), few)
    if chosen.where(F.col("m") > few).isEmpty():
        pairs = stored(pairs.unionAll(found), "further")
    else:
        several = many_pairs(texts, again.withColumn("sketch", F.col("sketch.before")), few)
        pairs = stored(pairs.unionAll(several).distinct().unionAll(found), "further")
        forget(several)
    forget(many, rest, chosen, stars, groups)
    return pairs


def evenly(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt over all shuffle partitions, also when they are few: each takes long."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def similar(a: Column, b: Column, n: Column, m: Column) -> Column:
    """Whether lists of shingles, n and m different ones, have a Jaccard similarity of 0.8 or more.

    Of n + m shingles the share s / (1 + s) has to be in both.
    """
    return F.size(F.array_intersect(a, b)) * (PARTS + SIMILAR_PARTS) >= (n + m) * SIMILAR_PARTS


def marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose ``near`` is wanted, and some others.

    The wanted numbers are marked in at most WORDS words of 64 bits, which every task gets, so that
    most other rows are left out before anything is shuffled.
    """
    word = F.pmod(F.shiftright("near", 6), F.lit(WORDS)).cast("int").alias("word")
    bit = F.col("near").bitwiseAND(F.lit(63)).cast("int").alias("bit")
    words = wanted.select(word, bit).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    placed = rows.select("*", word, bit).join(F.broadcast(words), "word")
    return placed.where(F.getbit("bits", F.col("bit")) == 1).drop("word", "bit", "bits")


def texts_of(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(near, same, line, size), once, of lines whose ``near`` is one of those wanted, which are different.

    ``size`` is the number of different shingles.
    """
    # A join on the numbers dealt evenly, as counting shingles takes long; a semi join would be moved below the marks.
    some = evenly(marked(lines.select("near", "line"), wanted), "near").join(wanted.hint("shuffle_hash"), "near")
    texts = some.select("near", _same("line").alias("same"), "line").distinct()
    return stored(texts.withColumn("size", F.size(F.array_distinct(shingles("line")))), "texts")


def ends_of(pairs: DataFrame) -> DataFrame:
    """(near), once, of both lines of pairs."""
    return pairs.select("near").unionAll(pairs.select("first")).distinct()


def verified(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b) and what else pairs (first, a, near, b) have, where all shingles are similar."""
    wanted = stored(ends_of(pairs), "wanted")
    texts = texts_of(lines, wanted)
    links = compared(texts, pairs)
    forget(wanted, texts)
    return links


def compared(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``verified`` with the texts of the lines, each once, and their sizes.

    Lines whose sizes are too far apart cannot be similar. Joins that bring long lines to a few
    numbers are hashed on the numbers, so that no text is sorted.
    """
    # A line with very many pairs has a copy for each share of them.
    shares = pairs.groupBy("first", "a").agg(F.ceil(F.count("*") / SHARE).alias("shares")).where("shares > 1")
    shares = stored(shares, "shares")
    several = F.coalesce("shares", F.lit(1).cast("long"))
    dealt = pairs.join(shares, ["first", "a"], "left").withColumn("share", F.pmod(F.xxhash64("b"), several)).drop("shares")
    one = texts.select(F.col("near").alias("first"), F.col("same").alias("a"), F.col("line").alias("left"), F.col("size").alias("n"))
    one = one.join(shares, ["first", "a"], "left").withColumn(
        "share", F.explode(F.sequence(F.lit(0).cast("long"), several - 1))
    ).drop("shares")
    two = texts.select("near", F.col("same").alias("b"), F.col("line").alias("right"), F.col("size").alias("m"))
    both = one.join(dealt.hint("shuffle_hash"), ["first", "a", "share"]).join(two, ["near", "b"])
    both = both.where(F.least("n", "m") * PARTS >= F.greatest("n", "m") * SIMILAR_PARTS).drop("share")
    alike = similar(shingles("left"), shingles("right"), F.col("n"), F.col("m"))
    links = stored(both.where(alike).drop("first", "near", "left", "right", "n", "m"), "verified")
    forget(shares)
    return links


def _linked(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Links of the first pass, their components, links between these with their ends, and lines that are there twice.

    First every member of a bucket is compared with the bucket's least line. Then all lines of
    buckets that still hold several components are compared with those of the other ones. Texts
    are read of lines of very large buckets and of pairs whose minima agree alone, and what is not
    read any more is removed.
    """
    held = stored(signatures(lines).select("near", "same", "copies", *packed()), "keyed", plain=True)
    found = buckets(held, SETS)
    known = stored(held.select("near", "same", "copies", sketch(pairs_of()).alias("sketch")), "known", plain=True)
    forget(held)
    repeated = stored(known.where("copies > 1").select("near", "same"), "repeated")
    rows = reduce(DataFrame.unionAll, found)
    ends = rows.where("near > first").select("first", "near").distinct()
    one = known.select(F.col("near").alias("first"), F.col("same").alias("a"), F.col("sketch").alias("against"))
    two = known.select("near", F.col("same").alias("b"), "sketch")
    pairs = ends.join(one.hint("shuffle_hash"), "first").join(two.hint("shuffle_hash"), "near")
    pairs = stored(pairs.where(agree(F.col("sketch"), F.col("against"))).select("first", "a", "near", "b"), "pairs")
    large = rows.where(F.col("n") > FEW).select("near")
    wanted = stored(ends_of(pairs).unionAll(large).distinct(), "wanted")
    texts = texts_of(lines, wanted)
    links = compared(texts, pairs)
    stars = stored(links.select("a", "b"), "stars")
    forget(pairs, links, wanted)
    groups = stored(connected(stars), "groups")
    # In a bucket of two, its least line was compared with the other one.
    crowded = mixed(rows.where("n > 2").select("key", "near"), groups, known.select("near", "same", "sketch"))
    forget(known, *found)
    chosen, apart = standing(crowded)
    few = stored(few_pairs(apart, agree(F.col("sketch"), F.col("against"))), "few")
    further = few
    if not chosen.where(F.col("m") > FEW).isEmpty():
        many = further_pairs(texts, crowded, apart, groups)
        further = stored(few.unionAll(many).distinct(), "pairs")
        forget(few, many)
    forget(crowded, chosen, texts)
    across = verified(lines, further)
    forget(further)
    return stars, groups, across, repeated


def line_links(lines: DataFrame) -> DataFrame:
    """(a, b): links between lines of different text, verified on all their shingles."""
    stars, _, across, _ = _linked(lines)
    return stars.unionAll(across.select("a", "b"))


def line_groups(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, component): the component of every line that has a link; (near, same): lines that are there twice."""
    _, groups, across, repeated = _linked(lines)
    return regrouped(groups, across), repeated


def line_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, version, pos, class, kept) for every line with a word.

    The class is the hash of one of its lines; ``kept`` marks its first line, by document id
    (null ids last), version of the text and position. Only lines that have a link or are there
    twice are shuffled and compared by place; the others are their own class.
    """
    lines = lines_of(docs)
    groups, repeated = line_groups(lines)
    groups = stored(groups, "classes")
    several = repeated.select("same").unionAll(groups.select("node")).distinct()
    several = several.join(groups.hint("shuffle_hash"), F.col("same") == F.col("node"), "left")
    several = stored(several.select("same", F.coalesce("component", "same").alias("class")), "several")
    places = lines.select("doc_id", "version", "pos", "same")
    number = F.xxhash64("same").alias("near")
    some = marked(places.select("*", number), several.select(number))
    named = some.join(several.hint("shuffle_hash"), "same").select("doc_id", "version", "pos", "class")
    named = stored(named, "places")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "pos")
    first = named.groupBy("class").agg(F.min(place).alias("first"))
    kept = place.eqNullSafe(F.col("first")).alias("kept")
    judged = named.join(first, "class").select("doc_id", "version", "pos", "class", kept)
    alone = places.join(several.hint("shuffle_hash"), "same", "left_anti")
    return judged.unionAll(alone.select("doc_id", "version", "pos", F.col("same").alias("class"), F.lit(True).alias("kept")))


def _without(text: Column, drop: Column) -> Column:
    """A text without the lines at some positions; it is split once."""
    parted = F.array(F.struct(F.split(text, "\n").alias("lines"), drop.alias("drop")))

    def rest(x: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["drop"])
        return F.array_join(F.transform(places, lambda i: F.get(x["lines"], i)), "\n")

    return F.element_at(F.transform(parted, rest), 1)


def drop_lines(docs: DataFrame) -> DataFrame:
    """The documents with one line kept of every class of lines that are the same or similar.

    Lines are what stands between line feeds. Two lines are linked when 0.8 or more of all
    their 5-character shingles are shared, and classes follow the links. A line without a
    word is no line in this sense and stays, as do null and empty texts. A document whose
    lines are all repeats stays with what is left, an empty text at the least. Rows that
    repeat both id and text are one document and are changed alike. The length in ``n_chars``
    follows the text. An empty table gives no rows; other columns pass through.
    """
    lost = line_classes(docs.select("doc_id", "text")).where(~F.col("kept"))
    drops = lost.groupBy("doc_id", "version").agg(F.collect_set("pos").alias("__drop"))
    drops = drops.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"), "__drop")
    same = docs["doc_id"].eqNullSafe(drops["__id"]) & (F.xxhash64(docs["text"]) == drops["__version"])
    joined = docs.join(drops.hint("shuffle_hash"), same, "left")
    text = F.when(F.col("__drop").isNull(), docs["text"]).otherwise(_without(docs["text"], F.col("__drop")))
    return with_text(joined, text).drop("__id", "__version", "__drop")
