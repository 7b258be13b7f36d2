"""SentencePiece encoding that keeps the place of every piece in the original bytes, and decoding."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ratewatch.llm.text import byte_slices

SPACE_PIECE = "▁"

# Kinds of pieces, and the kind of model, as the library's model files number them.
USER_DEFINED, BYTE = 4, 6
BPE = 2

# Bytes of text that are encoded at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20


class CharacterMap:
    """The compiled map of a normaliser: a double-array trie of prefixes, and what replaces them.

    The blob holds the size of the trie in bytes, its units of 32 bits, and the replacements,
    each ended by a zero. A unit's bits are its label (8), whether it has a value (1), the
    scale and size of the offset to its children.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.replacements = blob[4 + size :]

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes]:
        """The length of the longest prefix at a place that the map knows, and its replacement."""
        node, best, value = self._children(self.units[0]), 0, 0
        for end in range(at, len(text)):
            node ^= text[end]
            unit = self.units[node]
            if unit & 0x800000FF != text[end]:
                break
            node ^= self._children(unit)
            if unit >> 8 & 1:
                best, value = end + 1 - at, self.units[node] & 0x7FFFFFFF
        if not best:
            return 0, b""
        return best, self.replacements[value : self.replacements.index(0, value)]


class Normalizer:
    """Text as a model wants it, with the place in the original of every byte."""

    def __init__(self, spec, suffix: bool = False):
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix = spec.add_dummy_prefix and not suffix
        self.suffix = spec.add_dummy_prefix and suffix
        self.strip = spec.remove_extra_whitespaces
        self.space = SPACE_PIECE.encode() if spec.escape_whitespaces else b" "

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the byte of the original.

        All bytes of a replacement are at the start of what they replace.
        """
        raw = text.encode()
        if not raw:
            return "", np.zeros(1, np.int64)
        if self.map is None and not self.strip:
            return self._escaped(text, raw)
        return self._replaced(raw)

    def _escaped(self, text: str, raw: bytes) -> tuple[str, np.ndarray]:
        """Without a map only spaces change."""
        space = self.space.decode()
        before, after = space * self.prefix, space * self.suffix
        width = len(self.space)
        sizes = np.where(np.frombuffer(raw, np.uint8) == 0x20, width, 1)
        places = np.repeat(np.arange(len(raw)), sizes)
        ends = (np.zeros(width * self.prefix, np.int64), np.full(width * self.suffix + 1, len(raw)))
        return before + text.replace(" ", space) + after, np.concatenate([ends[0], places, ends[1]])

    def _next(self, raw: bytes, at: int) -> tuple[int, bytes]:
        """How many bytes are read at a place, and what stands for them."""
        size, new = self.map.longest(raw, at) if self.map else (0, b"")
        if size:
            return size, new
        first = raw[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return size, raw[at : at + size]

    def _replaced(self, raw: bytes) -> tuple[str, np.ndarray]:
        out, places = bytearray(), []

        def put(piece: bytes, at: int) -> None:
            piece = piece.replace(b" ", self.space)
            out.extend(piece)
            places.extend([at] * len(piece))

        at = 0
        while self.strip and at < len(raw):
            size, new = self._next(raw, at)
            if new != b" ":
                break
            at += size
        if at == len(raw):
            return "", np.full(1, 0)
        if self.prefix:
            put(b" ", at)
        after_space = self.strip
        while at < len(raw):
            size, new = self._next(raw, at)
            if after_space:
                new = new.lstrip(b" ")
            if new:
                put(new, at)
                after_space = self.strip and new.endswith(b" ")
            at += size
        while self.strip and out.endswith(self.space):
            at = places[len(out) - len(self.space)]
            del out[-len(self.space) :], places[-len(self.space) :]
        if self.suffix:
            put(b" ", at)
        return out.decode(), np.array([*places, at], np.int64)


class Encoder:
    """Ids of normalised text by the model's merges, and the spans of the pieces.

    Merging is the library's, set up without any normalisation of its own.
    """

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        trainer = proto.trainer_spec
        kinds = np.array([p.type for p in proto.pieces])
        if trainer.model_type != BPE or not trainer.byte_fallback or (kinds == USER_DEFINED).any():
            raise ValueError("the model must be BPE with byte fallback and without user-defined pieces")
        self.normalizer = Normalizer(proto.normalizer_spec, trainer.treat_whitespace_as_suffix)
        self.end = trainer.eos_id
        self.whole = SentencePieceProcessor(model_proto=model)
        # Bytes of normalised text that a piece stands for; the byte of those that are one.
        self.sizes = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in proto.pieces])
        self.byte = np.array([int(p.piece[3:5], 16) if p.type == BYTE else -1 for p in proto.pieces])
        plain = proto.normalizer_spec
        plain.Clear()
        plain.name = "identity"
        plain.add_dummy_prefix = plain.remove_extra_whitespaces = plain.escape_whitespaces = False
        self.merger = SentencePieceProcessor(model_proto=proto.SerializeToString())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(offsets, ids, starts, ends) of all texts in a row, with an end id after each.

        Of the bytes that stand for one character, the last spans the character, and those
        before it nothing at its start, as in the library.
        """
        normalised = [self.normalizer(t) for t in texts]
        merged = self.merger.encode([t for t, _ in normalised], num_threads=1)
        # Pieces and bytes of normalised text up to each document.
        pieces = np.cumsum([0, *map(len, merged)])
        ids = np.fromiter(chain.from_iterable(merged), np.int32, pieces[-1])
        sizes = self.sizes[ids]
        bytes_to = np.cumsum([0, *(len(places) - 1 for _, places in normalised)])
        owner = np.repeat(np.arange(len(texts)), np.diff(pieces))
        ends = np.cumsum(sizes)
        if len(ids) and (ends[pieces[1:] - 1] != bytes_to[1:])[np.diff(pieces) > 0].any():
            raise ValueError("the pieces do not make up the text")
        places = np.concatenate([p for _, p in normalised]) if texts else np.zeros(0, np.int64)
        byte = self.byte[ids]
        inner = (byte >= 0x80) & (byte < 0xC0)
        begins = ends - sizes
        # A byte within a character starts where the character does.
        lead = np.maximum.accumulate(np.where(inner, 0, np.arange(len(ids)))) if len(ids) else begins
        starts = places[begins[lead] + owner]
        last = ~np.append(inner[1:], False)
        stops = np.where(last | (byte < 0), places[ends + owner], starts)
        # The places have one entry more in each document, that of its end.
        close = pieces[1:]
        whole = np.array([p[-1] for _, p in normalised], np.int64)
        offsets = pieces + np.arange(len(pieces))
        return (
            offsets,
            np.insert(ids, close, self.end),
            np.insert(starts, close, whole),
            np.insert(stops, close, whole),
        )


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, starts, ends, decoded): the pieces of every text with an end id after them.

    The ids are those of the sentencepiece library for the model at ``model_path``, without
    sampling. Piece k stands for the bytes from ``starts[k]`` up to ``ends[k]`` of the text in
    UTF-8; a space that the model puts before a text, and the end id, span nothing, and of the
    bytes of a character without a piece only the last spans it. ``decoded`` is what the
    library's ``decode`` makes of the ids.

    The normaliser takes at each place the longest prefix that the model's compiled character
    map knows and notes where it came from. Models must be BPE with byte fallback and have no
    user-defined pieces; others raise ValueError.

    Every document is a row of its own, so repeated rows and null ids give rows of their own;
    null and empty texts have the end id alone and decode to an empty text; other columns are
    left out; an empty table gives no rows. There is no shuffle. The model goes to the workers
    with the function.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    Encoder(model)
    kept = docs.select("doc_id", "text")
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, "
    schema += "ids array<int>, starts array<int>, ends array<int>, decoded string"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for part in byte_slices(batches, "text", SLICE_BYTES):
            offsets, ids, starts, ends = encoder.encode([t or "" for t in part.column("text").to_pylist()])
            flat, cuts = ids.tolist(), offsets.tolist()
            decoded = [encoder.whole.decode(flat[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            columns = [part.column("doc_id"), *(_lists(offsets, x) for x in (ids, starts, ends)), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "starts", "ends", "decoded"])

    return kept.mapInArrow(encode, schema)
