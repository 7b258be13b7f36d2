"""Token ids in blocks of an interleaved range asymmetric numeral system with static tables."""

from __future__ import annotations

import json
import re
import struct
import sys
import zlib
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewatch.session import run_folder, stored

END_ID = 1

# Frequencies add up to 2^20. A state is kept in [2^31, 2^63) by words of 32 bits.
SCALE_BITS = 20
LOW_BITS = 31
WORD_BITS = 32

# Ids of a block (whole documents, so a long one has a block of its own), and the most
# lanes that take turns in it.
BLOCK_IDS = 1 << 18
LANES = 1024
LANE_IDS = 64

# Rounds of all lanes between two checkpoints.
CHECKPOINT = 64

MAGIC = b"IDB1"
HEADER = "<4sIIIIII"
HEADER_BYTES = struct.calcsize(HEADER)

# What makes the case of A-Z matter: added tokens, which are found in the raw text, and
# capitals before a mark, which compose (or do not) before they are lowered.
CASED = re.compile(rb"<\||[A-Z][\x80-\xff]")

# Words of letters that compose with nothing and have one lower form, and ASCII marks of which
# no added token is made; and the rules by which a tokenizer takes these two as one piece each.
PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-/:;=?@\[-`{}~]*)")
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}

# Words that a worker remembers the ids of, twice.
REMEMBERED = 600_000


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to the table's sum, at least 1 for whatever occurs.

    The rounding is settled at the largest ones, in order of size and then of number.
    """
    counts = np.asarray(counts, float)
    total = 1 << SCALE_BITS
    if not counts.sum():
        return np.zeros(len(counts), np.int64)
    scaled = np.where(counts > 0, np.maximum(1, np.floor(counts / counts.sum() * total)), 0).astype(np.int64)
    order = np.lexsort((np.arange(len(counts)), -counts))
    off = total - int(scaled.sum())
    scaled[order[0]] += max(off, 0)
    for at in order:
        if off >= 0:
            break
        taken = min(int(scaled[at]) - 1, -off)
        scaled[at] -= taken
        off += taken
    return scaled


class Tables:
    """Frequencies, their running sums, and the symbol of every slot."""

    def __init__(self, scaled: np.ndarray):
        self.scaled = scaled.astype(np.uint64)
        self.starts = (np.cumsum(scaled) - scaled).astype(np.uint64)
        self.symbols = np.repeat(np.arange(len(scaled), dtype=np.uint32), scaled)
        self.digest = zlib.crc32(scaled.astype("<u4").tobytes())


def encode(ids: np.ndarray, tables: Tables) -> bytes:
    """One block: header, checkpoints and words.

    Lane k holds the ids k, k + lanes, k + 2 lanes, ...; all lanes take a step together, from
    the last round to the first. A checkpoint holds all states before a round and how many
    words the rounds before it take, so that decoding can start there; a checksum covers the
    ids up to the next one.
    """
    ids = np.asarray(ids, np.int64)
    lanes = max(1, min(LANES, len(ids) // LANE_IDS))
    rounds = -(-len(ids) // lanes)
    frequency, start = tables.scaled[ids], tables.starts[ids]
    if len(ids) and not frequency.all():
        raise ValueError("an id that the tables do not have")
    states = np.full(lanes, 1 << LOW_BITS, np.uint64)
    scale, word = np.uint64(SCALE_BITS), np.uint64(WORD_BITS)
    limit = np.uint64(LOW_BITS + WORD_BITS - SCALE_BITS)
    emitted: list[np.ndarray] = []
    written = 0
    marks: list[tuple[int, bytes]] = []
    for r in range(rounds - 1, -1, -1):
        f, c = frequency[r * lanes : (r + 1) * lanes], start[r * lanes : (r + 1) * lanes]
        live = states[: len(f)]
        full = live >= (f << limit)
        if full.any():
            out = live[full]
            emitted.append(out.astype("<u4"))
            written += len(out)
            live[full] = out >> word
        quotient = live // f
        states[: len(f)] = (quotient << scale) + (live - quotient * f) + c
        if r % CHECKPOINT == 0:
            marks.append((written, states.astype("<u8").tobytes()))
    body = np.concatenate(emitted[::-1]).tobytes() if emitted else b""
    pieces = []
    step = CHECKPOINT * lanes
    for k, (after, raw) in enumerate(reversed(marks)):
        check = zlib.crc32(ids[k * step : (k + 1) * step].astype("<u4").tobytes())
        pieces.append(struct.pack("<II", written - after, check) + raw)
    head = struct.pack(HEADER, MAGIC, tables.digest, len(ids), lanes, len(marks), written, zlib.crc32(b"".join(pieces) + body))
    return head + b"".join(pieces) + body


def segments(block: bytes) -> int:
    """The number of stretches of a block that can be decoded on their own."""
    return struct.unpack_from(HEADER, block)[4]


def decode_segment(block: bytes, at: int, tables: Tables) -> np.ndarray:
    """The ids from one checkpoint to the next; raises ValueError where they are not whole."""
    magic, digest, n, lanes, marks, _, _ = struct.unpack_from(HEADER, block)
    if magic != MAGIC or digest != tables.digest:
        raise ValueError("not a block of these tables")
    size = 8 + 8 * lanes
    offset = HEADER_BYTES + at * size
    position, check = struct.unpack_from("<II", block, offset)
    states = np.frombuffer(block, "<u8", lanes, offset + 8).astype(np.uint64)
    words = np.frombuffer(block, "<u4", offset=HEADER_BYTES + marks * size)
    scale, mask = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
    low, word = np.uint64(1 << LOW_BITS), np.uint64(WORD_BITS)
    first = at * CHECKPOINT * lanes
    out = np.empty(min(n - first, CHECKPOINT * lanes), np.int64)
    for begin in range(0, len(out), lanes):
        live = states[: min(lanes, len(out) - begin)]
        slots = live & mask
        found = tables.symbols[slots]
        out[begin : begin + lanes] = found
        live[:] = tables.scaled[found] * (live >> scale) + slots - tables.starts[found]
        empty = live < low
        taken = int(empty.sum())
        if taken:
            live[empty] = (live[empty] << word) | words[position : position + taken]
            position += taken
    if zlib.crc32(out.astype("<u4").tobytes()) != check:
        raise ValueError("a checksum does not fit")
    return out


def decode(block: bytes, tables: Tables) -> np.ndarray:
    """All ids of a block."""
    size = struct.unpack_from(HEADER, block)[6]
    if zlib.crc32(block[HEADER_BYTES :]) != size:
        raise ValueError("a block is damaged")
    parts = [decode_segment(block, k, tables) for k in range(segments(block))]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian numbers of 16 bits."""
    return struct.pack(f"<{len(ids)}H", *ids)


class Known(dict):
    """Ids by word. A word that is not there is asked for once, and kept.

    When ``REMEMBERED`` words are known, those that were not met since the last time are
    forgotten.
    """

    def __init__(self, encoded: Callable[[bytes], bytes]):
        super().__init__()
        self.encoded = encoded
        self.before: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.encoded(word)
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Words:
    """Ids of texts by the ids of what stands between ASCII white space.

    The tokenizer parts texts at white space and treats A-Z like a-z but in ``CASED`` words, so
    a text's ids are those of its words, and each word is encoded once and remembered, lowered
    if its case does not matter. Where the tokenizer's rules are ``RULES``, a word of letters
    with or without marks behind it is parted here and its letters go to the tokenizer's model
    alone; such letters are the same in all the rules' forms but for their case. All other words
    go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        rules = json.loads(self.tokenizer.to_str())
        self.plain = PLAIN if all(rules[k] == v for k, v in RULES.items()) else None
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.units = {ord(c): level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xC0, 0x100))}
        self.known = Known(self.encoded)

    def encoded(self, word: bytes) -> bytes:
        """Ids of one word."""
        text = word.decode()
        parts = self.plain and self.plain.fullmatch(text)
        if not parts:
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        letters, marks = parts.groups()
        if marks:
            word = letters.encode()
            ids = self.known.get(word) or self.known.before.get(word) or self.encoded(word)
            return ids + self.known[marks.encode()]
        letters = letters.lower()
        pieces = self.model.tokenize(letters if letters.isascii() else letters.translate(self.units))
        return packed([t.id for t in pieces])

    @staticmethod
    def parted(text: str) -> list[bytes]:
        """The words of a text as they are remembered."""
        raw = text.encode()
        if (text.isascii() and "<|" not in text) or not CASED.search(raw):
            return raw.lower().split()
        return [w if CASED.search(w) else w.lower() for w in raw.split()]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text with the end id, as little-endian numbers of 16 bits."""
        end = packed([END_ID])
        return [b"".join(map(self.known.__getitem__, self.parted(t or ""))) + end for t in texts]


def encoder(path: str) -> Words:
    """The worker's encoder. Functions come to a worker by value, so what tasks of one worker
    share has to be kept by name."""
    shared = sys.modules.setdefault("_ratewatch_encoders", ModuleType("_ratewatch_encoders"))
    if not hasattr(shared, path):
        setattr(shared, path, Words(path))
    return getattr(shared, path)


BLOCKS = "part long, block long, nulls long, doc_ids array<long>, sizes array<long>, ids binary"


def token_blocks(docs: DataFrame, path: str, parts: int | None = None) -> DataFrame:
    """(part, block, nulls, doc_ids, sizes, ids): ids of whole documents in ascending order of ids.

    Null ids come first; ``nulls`` counts them, and 0 stands for them.

    Documents are dealt by ranges of their ids. Numbers of 16 bits hold the ids, of which the
    vocabulary has fewer than 65,536.
    """
    rows = docs.select("doc_id", "text")
    number = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(number, F.col("doc_id").asc_nulls_first())
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ranged = ranged.select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(path)
        block, held = 0, 0
        waiting: list[tuple[int | None, bytes]] = []
        part = 0

        def flush() -> pd.DataFrame:
            nonlocal block, held
            frame = pd.DataFrame(
                {
                    "part": [part],
                    "block": [block],
                    "nulls": [sum(d is None for d, _ in waiting)],
                    "doc_ids": [[d or 0 for d, _ in waiting]],
                    "sizes": [[len(x) // 2 for _, x in waiting]],
                    "ids": [b"".join(x for _, x in waiting)],
                }
            )
            block, held = block + 1, 0
            waiting.clear()
            return frame

        for batch in batches:
            part = int(batch["part"].iloc[0])
            names = [None if pd.isna(d) else int(d) for d in batch["doc_id"]]
            texts = batch["text"].tolist()
            for start in range(0, len(texts), 512):
                some = coder.ids(texts[start : start + 512])
                for name, ids in zip(names[start : start + 512], some, strict=True):
                    if waiting and held + len(ids) // 2 > BLOCK_IDS:
                        yield flush()
                    waiting.append((name, ids))
                    held += len(ids) // 2
        if waiting:
            yield flush()

    return ranged.mapInPandas(cut, BLOCKS)


def id_counts(blocks: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs; one number for each id of the vocabulary comes to the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch["ids"]:
                total += np.bincount(np.frombuffer(ids, "<u2"), minlength=size)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"id": at, "n": total[at]})

    found = blocks.select("ids").mapInPandas(count, "id long, n long")
    sums = found.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[sums["id"].to_numpy(int)] = sums["n"].to_numpy(int)
    return counts


def write(docs: DataFrame, folder: str, path: str) -> None:
    """Write the ids of all documents: blocks, and the table of frequencies.

    ``folder``/blocks has for each block its place (part, block), the ids and sizes of its
    documents and the encoded bytes; ``folder``/table has the frequency of every id. Both are
    Parquet files, so that any store that Spark reaches will do. Ids are counted over all
    documents first.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    blocks = stored(token_blocks(docs, path), "ids")
    scaled = frequencies(id_counts(blocks, Tokenizer.from_file(path).get_vocab_size()))
    table = pd.DataFrame({"id": np.arange(len(scaled)), "frequency": scaled})
    spark.createDataFrame(table, "id long, frequency long").coalesce(1).write.parquet(f"{folder}/table")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = Tables(scaled)
        for batch in batches:
            for at in range(len(batch)):
                row = batch.iloc[at : at + 1]
                data = encode(np.frombuffer(row["ids"].iloc[0], "<u2"), tables)
                yield row.drop(columns="ids").assign(data=[data])

    blocks.mapInPandas(pack, BLOCKS.replace("ids binary", "data binary")).write.parquet(f"{folder}/blocks")


def _frequencies(spark: SparkSession, folder: str) -> np.ndarray:
    return spark.read.parquet(f"{folder}/table").orderBy("id").toPandas()["frequency"].to_numpy(np.int64)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of ``write``.

    ``start`` counts the ids of all documents before it in the files' order. Blocks are
    decoded each on its own, and every checksum is compared.
    """
    scaled = _frequencies(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda n, x: n + x)
    sums = blocks.select("part", "block", size.alias("size"))
    whole = sums.groupBy("part").agg(F.sum("size").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = whole.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    starts = starts.join(offsets, "part").select("part", "block", (F.col("offset") + F.col("inside")).alias("start"))

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = Tables(scaled)
        for batch in batches:
            columns = [batch[c] for c in ("part", "block", "nulls", "doc_ids", "sizes", "data")]
            for part, block, nulls, names, sizes, data in zip(*columns, strict=True):
                ids = decode(data, tables).astype("<u4")
                numbers = pd.array(names, "Int64")
                numbers[:nulls] = pd.NA
                ends = np.cumsum(sizes)
                yield pd.DataFrame(
                    {
                        "part": part,
                        "block": block,
                        "doc_id": numbers,
                        "inside": ends - sizes,
                        "n_tokens": sizes,
                        "ids_crc32": [
                            zlib.crc32(ids[end - n : end].tobytes()) for end, n in zip(ends, sizes, strict=True)
                        ],
                    }
                )

    kind = "part long, block long, doc_id long, inside long, n_tokens long, ids_crc32 long"
    found = blocks.mapInPandas(unpack, kind)
    return found.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Write all documents to a folder of this run and read them back.

    Null texts are empty and have the end id only. Documents come in ascending order of ids,
    null first and rows that share an id in order of their texts. An empty table gives no
    rows.
    """
    folder = run_folder(docs.sparkSession, "token-ids")
    write(docs, folder, path)
    return read(docs.sparkSession, folder)
