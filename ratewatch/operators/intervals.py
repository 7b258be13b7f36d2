"""Rows joined to the intervals that contain their time, or counted in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewatch.session import forget, stored

# Bins of the shortest intervals in microseconds, and how much longer those of the next level are.
BASE_MICROS = 1_000_000
GROWTH = 8


def _level(length: Column) -> Column:
    """The level whose bins are at least as long as the interval and not GROWTH times as long."""
    steps = F.log(length / F.lit(BASE_MICROS)) / F.log(F.lit(float(GROWTH)))
    return F.greatest(F.ceil(steps), F.lit(0)).cast("int")


def _bin(micros: Column, level: Column) -> Column:
    size = F.pow(F.lit(GROWTH), level).cast("long") * BASE_MICROS
    return F.floor((micros - F.pmod(micros, size)) / size)


def within(
    rows: DataFrame,
    intervals: DataFrame,
    by: tuple[str, ...] = ("fx_marker",),
    ts: str = "ts",
    start: str = "window_start",
    end: str = "window_end",
    how: str = "left",
    parts: int = 1,
    per: tuple[str, ...] | None = None,
) -> DataFrame:
    """Every row with every interval of the same ``by`` that holds its time, start <= ts < end.

    Intervals may overlap, repeat and have any length. The result has the columns of ``rows``
    and those of ``intervals`` but ``by``. With ``how="left"`` a row in no interval, or without
    a time, comes once with nulls; with ``"inner"`` it is left out. Intervals without a start or
    an end, or that end before they start, hold nothing; a null in ``by`` equals nothing.

    Time is cut into bins, and the join is on ``by`` and bin, with the exact comparison behind
    it: no nested loop, and a marker with very many rows is spread over its bins. Bins are as
    long as the intervals: an interval takes a level by its length, where it lies in one bin or
    two, and a row has one bin in every level that occurs, of which there are few (a level is
    eight times the one before). For bins with very many rows, ``parts`` cuts each into so many
    and gives every part a copy of the intervals; adaptive execution also splits them.

    With ``per`` the rows are not listed but counted: for every interval and every value of
    these columns of ``rows`` with a row in it, the columns of ``intervals``, those in ``per``
    and the number ``n`` of rows, see ``counted``. This takes ``how="inner"``.
    """
    if per is not None:
        if how != "inner":
            raise ValueError("rows are counted in intervals with how='inner' only")
        return counted(rows, intervals, per, by, ts, start, end, parts)
    begin, stop = F.unix_micros(start), F.unix_micros(end)
    proper = intervals.where(F.col(start) < F.col(end)).withColumn("_level", _level(stop - begin))
    levels = sorted(r[0] for r in proper.select("_level").distinct().collect())
    bins = F.sequence(_bin(begin, F.col("_level")), _bin(stop - 1, F.col("_level")))
    added = F.struct(*[F.col(f"`{c}`") for c in intervals.columns if c not in by]).alias("_interval")
    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part")
    held = proper.select(*by, added, "_level", F.explode(bins).alias("_bin")).select("*", part)

    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    given = rows.select(row, F.unix_micros(ts).alias("_at"), *by)
    given = given.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts)).cast("int"))

    def matched(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
        left = left.withColumn("_bin", _bin(F.col("_at"), F.col("_level"))).alias("r")
        keys = [F.col(f"r.{c}") == F.col(f"i.{c}") for c in (*by, "_level", "_bin", "_part")]
        low, high = F.unix_micros(f"_interval.{start}"), F.unix_micros(f"_interval.{end}")
        return left.join(right.alias("i"), [*keys, F.col("_at") >= low, F.col("_at") < high], kind)

    if how == "left" and len(levels) <= 1:
        one = given.withColumn("_level", F.lit(levels[0] if levels else 0))
        return matched(one, held, "left").select("_row.*", "_interval.*")
    every = given.withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    found = matched(every, held, "inner").select("_row.*", "_interval.*")
    if how == "inner":
        return found
    # With several levels the rows in no interval are those that no level holds.
    for level in levels:
        at_level = given.withColumn("_level", F.lit(level))
        given = matched(at_level, held.where(F.col("_level") == level), "left_anti").select(*given.columns)
    empty = [F.lit(None).cast(held.schema["_interval"].dataType[c].dataType).alias(c) for c in intervals.columns if c not in by]
    return found.unionAll(given.select("_row.*", *empty))


def _reached(seen: DataFrame, points: DataFrame, parts: int) -> DataFrame:
    """(_by, _group, _at, _before): the rows of each group before each of the times in ``points``.

    Rows and times are ordered together by range, so that neither a group nor a time with very
    many rows makes a large task; a running count starts at 0 in each of these ranges, and the
    ranges before it are added as one number a group.
    """
    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part")
    groups = stored(seen.select("_by", "_group").distinct().select("*", part), "groups")
    dealt = points.withColumn("_part", F.pmod(F.xxhash64("_at"), F.lit(parts)).cast("int"))
    asked = dealt.join(groups, ["_by", "_part"])
    # A row at the time itself is not before it.
    both = seen.select("_by", "_group", "_at", F.lit(1).alias("_kind"), "_n").unionAll(
        asked.select("_by", "_group", "_at", F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_n"))
    )
    number = int(seen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = both.repartitionByRange(number, "_by", "_group", "_at").withColumn("_range", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    sums = ranged.groupBy("_by", "_group", "_range").agg(F.sum("_n").alias("_sum"))
    earlier = Window.partitionBy("_by", "_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_by", "_group", "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    running = Window.partitionBy("_by", "_group", "_range").orderBy("_at", "_kind")
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("_inside", F.sum("_n").over(running)).where("_kind = 0")
    placed = placed.join(offsets, ["_by", "_group", "_range"])
    found = stored(placed.select("_by", "_group", "_at", (F.col("_inside") + F.col("_offset")).alias("_before")), "reached")
    forget(groups, ranged)
    return found


def counted(
    rows: DataFrame,
    intervals: DataFrame,
    per: tuple[str, ...],
    by: tuple[str, ...] = ("fx_marker",),
    ts: str = "ts",
    start: str = "window_start",
    end: str = "window_end",
    parts: int = 1,
) -> DataFrame:
    """How many rows of each value of ``per`` lie in every interval; intervals are as in ``within``.

    The columns are those of ``intervals``, ``per`` and the number ``n``, which is 1 at the
    least. Nulls in ``per`` are a value. A count is that of the rows before the end without
    those before the start, so work grows with the rows and with the intervals times the values
    of ``per`` that occur in their ``by``, and not with the rows that intervals hold. Groups
    meet the times of intervals in ``parts`` parts.
    """
    key = [F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in by]]
    whole = [F.col(f"`{c}`").isNotNull() for c in by]

    def complete(frame: DataFrame) -> DataFrame:
        for there in whole:
            frame = frame.where(there)
        return frame

    group = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in per]).alias("_group")
    timed = complete(rows.where(F.col(ts).isNotNull()))
    timed = timed.select(F.struct(*key).alias("_by"), group, F.unix_micros(ts).alias("_at"))
    seen = stored(timed.groupBy("_by", "_group", "_at").agg(F.count("*").alias("_n")), "seen")

    given = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in intervals.columns]).alias("_interval")
    spans = complete(intervals.where(F.col(start) < F.col(end))).select(
        F.struct(*key).alias("_by"), given, F.unix_micros(start).alias("_begin"), F.unix_micros(end).alias("_stop")
    )
    points = spans.select("_by", F.explode(F.array("_begin", "_stop")).alias("_at")).distinct()
    reached = _reached(seen, points, parts)
    forget(seen)
    low = reached.withColumnsRenamed({"_at": "_begin", "_before": "_low"})
    high = reached.withColumnsRenamed({"_at": "_stop", "_before": "_high"})
    held = spans.join(low, ["_by", "_begin"]).join(high, ["_by", "_group", "_stop"]).where("_high > _low")
    return held.select(
        *[F.col(f"_interval.`{c}`") for c in intervals.columns],
        *[F.col(f"_group.`{c}`") for c in per],
        (F.col("_high") - F.col("_low")).alias("n"),
    )
