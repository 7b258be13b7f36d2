"""Words and columns as every operator here takes them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewatch.session import stored

# Words are what stands between these white-space characters. In Python,
# ``bytes.split()`` splits at exactly the same ones, and ``bytes.lower()`` lowers A-Z only.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: str | None) -> list[bytes]:
    """The words of a text, with A-Z in lower case."""
    return (text or "").encode().lower().split()


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """Put another text in place, and its length where the documents carry one."""
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return docs.withColumns(changed)


def numbered(rows: DataFrame, keys: tuple[str, ...], most: int = 4096) -> DataFrame:
    """Rows with a ``number`` from 1 among those with the same keys, which tells equal rows apart.

    Rows of a key are dealt over parts of some thousands and numbered there, and the parts
    are counted up, so a key with very many rows is in no task as a whole. Keys are not null.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    part = F.floor(F.rand(42) * F.ceil(F.col("__n") / most)).cast("long")
    dealt = stored(rows.join(counts, list(keys)).withColumn("__part", part).drop("__n"), "numbered")
    sizes = dealt.groupBy(*keys, "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    here = Window.partitionBy(*keys, "__part").orderBy("__part")
    found = dealt.join(offsets, [*keys, "__part"])
    return found.withColumn("number", F.col("__offset") + F.row_number().over(here)).drop("__part", "__offset")


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices with about ``limit`` bytes of the column; a larger value is alone."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        numbers = np.cumsum(sizes) // limit
        cuts = np.flatnonzero(np.diff(numbers)) + 1
        for begin, end in pairwise([0, *cuts.tolist(), len(sizes)]):
            if end > begin:
                yield batch.slice(begin, end - begin)
