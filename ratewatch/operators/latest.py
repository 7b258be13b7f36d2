"""Last write wins, and the most recent rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts that each group is cut in first, so that no task has to sort a hot group whole.
PARTS = 64


def latest(rows: DataFrame, keys: tuple[str, ...], *order: str) -> DataFrame:
    """The row with the greatest ``order`` per key; a single ``order`` column is kept.

    With one order column there is one ``max_by`` per column instead of one over a struct:
    with numbers and dates the buffers have a fixed width, so Spark uses a hash aggregate
    that combines before the shuffle, and a key with very many versions costs one row per
    task. All columns see the same rows in the same order, so they always come from the
    same version. A row whose order is null loses to any other, and is kept where it is alone. Several order columns need a struct, and Spark then sorts; rows equal in
    all of them are told apart by their values, so a rerun gives the same row.
    """
    values = [c for c in rows.columns if c not in keys and c not in order]
    # ``max_by`` leaves rows out whose order is null.
    rank = _rank(rows, order[0]) if len(order) == 1 else None
    if len(order) > 1:
        best = F.max(F.struct(*order, *values)).alias("best")
        return rows.groupBy(*keys).agg(best).select(*keys, *[F.col("best")[c].alias(c) for c in values])
    aggregates = [F.max_by(c, rank).alias(c) for c in values]
    return rows.groupBy(*keys).agg(*aggregates, F.max(order[0]).alias(order[0]))


def _rank(rows: DataFrame, order: str) -> Column:
    """The order with null as its least value."""
    if isinstance(rows.schema[order].dataType, T.LongType | T.IntegerType):
        return F.coalesce(F.col(order).cast("bigint"), F.lit(-(2**63)))
    if isinstance(rows.schema[order].dataType, T.TimestampType):
        return F.coalesce(F.unix_micros(order), F.lit(-(2**63)))
    kind = rows.schema[order].dataType
    if isinstance(kind, T.DecimalType):
        return F.coalesce(F.col(order), F.lit("-" + "9" * (kind.precision - kind.scale)).cast(kind))
    return F.struct(F.col(order).isNotNull().alias("there"), F.col(order))


def recent(rows: DataFrame, n: int, *newest: str) -> DataFrame:
    """The ``n`` newest rows, newest first; further columns break ties."""
    return rows.orderBy(*[F.desc(c) for c in newest]).limit(n)


def recent_per(rows: DataFrame, n: int, by: str, *newest: str, parts: int = PARTS) -> DataFrame:
    """The ``n`` newest rows of each ``by``.

    Each group is first cut to ``n`` in each of ``parts`` by the hash of ``newest``, then over
    these: the plan is the same for every ``n``, and also where Spark's own early cut is
    switched off, a hot group is sorted by ``parts`` tasks.
    """
    order = [F.desc(c) for c in newest]
    part = F.pmod(F.xxhash64(*newest), F.lit(parts))
    first = _ranked(rows.withColumn("_part", part), n, [F.col(by), F.col("_part")], order)
    return _ranked(first.drop("_part"), n, [F.col(by)], order)


def _ranked(rows: DataFrame, n: int, by: list[Column], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
