"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.llm import (
    bilinear,
    chat,
    kdtree,
    line_dedup,
    mixing,
    packing,
    periodic,
    pieces,
    quality,
    rans,
    simhash,
    whitening,
    wrapper,
)
from ratewatch.llm.text import WORD, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(query: Callable[[SparkSession, str], DataFrame]):
    QUERIES[query.__name__] = query
    return query


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary that the queries use; operators take a path."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op1_kdtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest inner products of every hundredth vector with all others."""
    return kdtree.top_k(table(spark, sf_dir, "embeddings"), every_row=True)


ORACLES["op1_kdtree_top_k"] = kdtree.TOP_K_SQL


@register
def op2_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under the base and the model."""
    return bilinear.scored(table(spark, sf_dir, "documents"))


@register
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document."""
    judged = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.drop("n_lines", "n_twins")


@register
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the text that line dedup leaves, and the lines before and after."""
    docs = table(spark, sf_dir, "documents")
    before = F.size(F.split("text", "\n")).alias("n_lines")
    left = line_dedup.drop_lines(docs.select("doc_id", "text", before))
    kept = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n")))
    return left.withColumn("n_kept", kept)


@register
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents"))


@register
def op6_main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return wrapper.extracted(table(spark, sf_dir, "pages"))


@register
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("key", "copies")


@register
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document's ids, from the files read back."""
    return rans.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


@register
def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op10_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered for each of its speakers, with the spans to learn from."""
    rotated = chat.rotated(table(spark, sf_dir, "conversations"))
    return rotated.withColumn("spans", chat.span_text("spans"))


ORACLES["op10_perspectives"] = chat.ROTATED_SQL


def planted(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by a checksum of the id, repeats its own words.

    With g = floor(crc32 / 10) the words from a = g % n on become those from a on with the
    period 1 + floor((n - a) / (3 + g % 8)).
    """
    found = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    found = found.withColumn("g", F.floor(F.col("h") / 10))
    found = found.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    found = found.withColumn("n", F.size("w"))
    found = found.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rest = F.col("n") - F.col("a")
    found = found.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    block = F.slice("w", F.col("a") + 1, F.col("p"))
    times = F.ceil(rest / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), rest)
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), tail)
    return found.select("doc_id", F.when(F.col("n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


@register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, and digests of them and of the text without repeats."""
    found = periodic.collapsed(planted(table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("before"), (-r.period).alias("finer")))
    found = found.withColumn("best", F.array_max(order))
    length, start, period = F.col("best.length"), -F.col("best.before"), -F.col("best.finer")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
        "n_words",
    )


@register
def op12_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and digests of every document's pieces, of their spans and of the decoded text."""
    found = pieces.encoded(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("starts", "ends").alias("spans_xxhash64"),
    )


@register
def op13_whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight greatest principal components, whitened."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
