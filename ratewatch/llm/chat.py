"""Dialogues rendered once for every participant, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewatch.session import stored

SYSTEM = "system"
UNKNOWN = "unknown"

# Turns, and messages, that one rendered row holds; longer dialogues go on in the next part.
PART_TURNS = 512

END = "<|end|>\n"


def _header(role: Column, speaker: Column) -> Column:
    """Who speaks, as seen by ``speaker``: the assistant, the system, or a named user."""
    return (
        F.when(role == speaker, F.lit("<|assistant|>\n"))
        .when(role == SYSTEM, F.lit("<|system|>\n"))
        .otherwise(F.concat(F.lit("<|user:"), role, F.lit("|>\n")))
    )


def _joined(a: DataFrame, b: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Two tables joined where some columns agree, null with null."""
    other = b.withColumnsRenamed({c: f"__{c}" for c in columns})
    equal = F.lit(True)
    for c in columns:
        equal = equal & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return a.join(other, equal, how).drop(*[f"__{c}" for c in columns])


def _numbered(rows: DataFrame) -> DataFrame:
    """(conv_id, part, message): messages of overfull stretches cut into parts by their number.

    Messages are ordered over all tasks, whatever their stretch, so that no task holds one;
    the number in a stretch is that in the task and what tasks before hold.
    """
    order = [F.col(c) for c in ("conv_id", "stretch", "message", "tie")]
    # Equal messages are told apart by a number, so that they can go to several tasks.
    rows = stored(rows.withColumn("tie", F.monotonically_increasing_id()), "overfull")
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(width, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumns({"task": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    ranged = stored(ranged, "ordered")
    held = ranged.groupBy("conv_id", "stretch", "task").agg(F.min("at").alias("least"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id", "stretch").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    joined = _joined(ranged, held, ["conv_id", "stretch", "task"])
    number = F.col("at") - F.col("least") + F.col("offset")
    part = F.col("first") + F.floor(number / PART_TURNS)
    return joined.select("conv_id", part.alias("part"), "message")


def parts(turns: DataFrame) -> DataFrame:
    """(conv_id, part, messages): the turns of a stretch of a dialogue in order.

    A stretch of turns that holds more messages than turns goes on in parts of its own, which
    move the dialogue's later parts up.
    """
    message = F.struct(
        "turn",
        F.coalesce("role", F.lit(UNKNOWN)).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    stretch = F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(0))
    counts = turns.groupBy("conv_id", stretch.alias("stretch")).agg(F.count("*").alias("n"))
    counts = stored(counts, "stretches")
    rows = turns.select("conv_id", stretch.alias("stretch"), message.alias("message"))
    if counts.where(F.col("n") > PART_TURNS).isEmpty():
        rows = rows.withColumnRenamed("stretch", "part")
    else:
        before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
        more = F.coalesce(F.sum(F.ceil(F.col("n") / PART_TURNS) - 1).over(before), F.lit(0))
        counts = stored(counts.withColumn("first", F.col("stretch") + more), "firsts")
        moved = counts.where((F.col("n") > PART_TURNS) | (F.col("first") != F.col("stretch")))
        moved = stored(moved, "moved")
        joined = _joined(rows, moved, ["conv_id", "stretch"], "left").withColumns(
            {"n": F.coalesce("n", F.lit(0)), "first": F.coalesce("first", "stretch")}
        )
        usual = joined.where(F.col("n") <= PART_TURNS).select("conv_id", F.col("first").alias("part"), "message")
        over = joined.where(F.col("n") > PART_TURNS).select("conv_id", "stretch", "first", "message")
        rows = usual.unionAll(_numbered(over))
    return rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("message")).alias("messages"))


def rotated(turns: DataFrame) -> DataFrame:
    """(conv_id, speaker, part, text, spans, n_turns, n_trained): each dialogue as each speaker sees it.

    Every role of a dialogue but the system's is a participant. In its row, its own messages
    are the assistant's, all others come from users with the role as name, and ``spans`` are
    the stretches of ``text`` (in code points, end excluded) that hold its messages and their
    end marks: those that a loss should count, ``n_trained`` code points together. Messages
    are ordered by turn, then role and text; repeated rows are rendered again. A null text is
    an empty message, a null role is a user named "unknown" who is no participant, a null
    turn comes first, null dialogue ids make one dialogue. A dialogue of 512 turns or more
    goes on in further parts by turn number, and one with more messages than that in a stretch
    of turns by their number, so that no row holds more than 512 messages. A dialogue
    without participants and an empty table give no rows. Texts are put in as they are.
    """
    speakers = turns.where((F.col("role") != SYSTEM) & F.col("role").isNotNull())
    speakers = speakers.select(F.col("conv_id").alias("of"), F.col("role").alias("speaker")).distinct()
    dialogues = parts(turns)
    seen = dialogues.join(speakers, dialogues["conv_id"].eqNullSafe(speakers["of"])).drop("of")
    rendered = F.transform(
        "messages",
        lambda m: F.struct(
            (m["role"] == F.col("speaker")).alias("own"),
            _header(m["role"], F.col("speaker")).alias("header"),
            F.concat(m["text"], F.lit(END)).alias("body"),
        ),
    )
    seen = seen.withColumn("pieces", rendered)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.char_length(piece["header"])
        end = start + F.char_length(piece["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        grown = F.when(piece["own"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), grown.alias("spans"))

    spans = F.aggregate("pieces", begin, step, lambda state: state["spans"])
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["header"], p["body"])), "")
    trained = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return seen.select(
        "conv_id",
        "speaker",
        F.col("part").cast("long").alias("part"),
        text.alias("text"),
        spans.alias("spans"),
        F.size("messages").cast("long").alias("n_turns"),
    ).withColumn("n_trained", trained)


def span_text(spans: str | Column) -> Column:
    """Spans as text: ``start-end`` joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ","
    )


ROTATED_SQL = """
WITH m AS (
  SELECT conv_id, turn, turn // 512 AS part, coalesce(role, 'unknown') AS role,
         coalesce(text, '') || '<|end|>' || chr(10) AS body
  FROM conversations
), s AS (
  SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role <> 'system'
), r AS (
  SELECT m.*, speaker, role = speaker AS own,
         CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
              ELSE '<|user:' || role || '|>' END || chr(10) AS header
  FROM m JOIN s USING (conv_id)
), o AS (
  SELECT *, sum(length(header) + length(body)) OVER (
           PARTITION BY conv_id, speaker, part ORDER BY turn, role, body
           ROWS UNBOUNDED PRECEDING) AS stop
  FROM r
)
SELECT conv_id, speaker, CAST(part AS BIGINT) AS part,
       string_agg(header || body, '' ORDER BY turn, role, body) AS text,
       coalesce(string_agg(CASE WHEN own THEN (stop - length(body)) || '-' || stop END, ','
                           ORDER BY turn, role, body), '') AS spans,
       count(*) AS n_turns,
       CAST(sum(CASE WHEN own THEN length(body) ELSE 0 END) AS BIGINT) AS n_trained
FROM o GROUP BY ALL
"""
