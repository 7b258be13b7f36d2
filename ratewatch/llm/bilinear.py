"""Log-bilinear language model, trained by noise-contrastive estimation and normalised exactly."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.llm.text import words
from ratewatch.session import stored

# Symbols of the model: the most frequent words, the end, and classes of all other words by
# their last two bytes. The table of normalisers has a number for each pair of symbols.
TOP_WORDS = 319
CLASSES = 192
DIMENSIONS = 24
CONTEXT = 2

# Noise words shared by a batch of tokens, and the steps of AdaGrad.
NOISE = 48
BATCH = 4096
RATE = 0.15
SEED = 42

# Characters of text that one task holds while it counts or scores.
CHUNK_CHARS = 12_000_000

FOLDS = 7
HELD_FOLD = 2


def held_out(doc_id: str | Column) -> Column:
    """Documents kept from training: crc32 of the id as text leaves 2 when divided by 7."""
    rest = F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % FOLDS
    return F.coalesce(rest == HELD_FOLD, F.lit(False))


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


@dataclass
class Symbols:
    """Numbers of the symbols, and how often each occurs in training."""

    top: dict[bytes, int]
    counts: np.ndarray

    @property
    def end(self) -> int:
        return len(self.top)

    def of(self, word: bytes) -> int:
        found = self.top.get(word)
        return self.end + 1 + word_class(word) if found is None else found

    @property
    def shares(self) -> np.ndarray:
        return (self.counts + 1.0) / (self.counts + 1.0).sum()


@dataclass
class Model:
    """Context vectors, target vectors, a weight vector for each context place, and biases."""

    context: np.ndarray
    target: np.ndarray
    places: np.ndarray
    bias: np.ndarray

    @staticmethod
    def fresh(symbols: Symbols) -> Model:
        rng = np.random.default_rng(SEED)
        n = len(symbols.counts)
        vectors = rng.normal(0, 0.3, (2, n, DIMENSIONS))
        return Model(
            vectors[0].astype(np.float32),
            vectors[1].astype(np.float32),
            np.full((CONTEXT, DIMENSIONS), 0.5, np.float32),
            np.log(symbols.shares).astype(np.float32),
        )

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        """The vector that each context (places as rows) predicts."""
        return sum(self.context[c] * p for c, p in zip(contexts, self.places, strict=True))

    def log_normalisers(self, contexts: np.ndarray, block: int = 8192) -> np.ndarray:
        """log of the sum over all symbols of e^score, by blocks of contexts."""
        out = np.empty(contexts.shape[1])
        for start in range(0, contexts.shape[1], block):
            scores = self.predicted(contexts[:, start : start + block]) @ self.target.T + self.bias
            top = scores.max(axis=1)
            out[start : start + block] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        return out

    def scores(self, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
        return np.einsum("td,td->t", self.predicted(contexts), self.target[targets]) + self.bias[targets]

    def by_place(self) -> list[np.ndarray]:
        """For each context place the scores of all symbols after each, the bias in the first.

        As a score is a sum over places, the score of a token is a sum of one of each.
        """
        tables = [(self.context * p) @ self.target.T for p in self.places]
        tables[0] += self.bias
        return tables


def _sums(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers of an index and the sums of their rows."""
    # Numbers of symbols fit 16 bits, which are sorted by radix.
    order = np.argsort(index.astype(np.int16), kind="stable")
    ordered = index[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    return ordered[starts], np.add.reduceat(rows[order], starts, axis=0)


class Trainer:
    """Stochastic steps on a model: true symbols against noise from the symbols' shares."""

    def __init__(self, model: Model, symbols: Symbols, seed: int):
        self.model, self.rng = model, np.random.default_rng(seed)
        self.log_noise = np.log(NOISE * symbols.shares).astype(np.float32)
        self.edges = np.cumsum(symbols.shares)
        self.squares = [np.full_like(x, 1e-2) for x in (model.context, model.target, model.places, model.bias)]
        self.tokens = 0

    def _step(self, which: int, values: np.ndarray, index: np.ndarray | slice, gradient: np.ndarray) -> None:
        square = self.squares[which]
        square[index] += gradient * gradient
        values[index] += np.float32(RATE) * gradient / np.sqrt(square[index])

    def batch(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        m = self.model
        places = [m.context[c] for c in contexts]
        predicted = sum(c * p for c, p in zip(places, m.places, strict=True))
        noise = np.searchsorted(self.edges, self.rng.random(NOISE)).clip(max=len(self.edges) - 1)
        noise_vectors, true_vectors = m.target[noise], m.target[targets]
        true = np.einsum("td,td->t", predicted, true_vectors) + m.bias[targets] - self.log_noise[targets]
        false = predicted @ noise_vectors.T + (m.bias[noise] - self.log_noise[noise])
        scale = np.float32(1 / np.sqrt(len(targets)))
        up = scale / (1 + np.exp(true.clip(-30, 30)))
        np.clip(false, -30, 30, out=false)
        np.exp(np.negative(false, out=false), out=false)
        down = np.divide(-scale, np.add(false, 1, out=false), out=false)
        back = up[:, None] * true_vectors + down @ noise_vectors
        at, sums = _sums(targets, np.column_stack([up[:, None] * predicted, up]))
        noise_at, noise_sums = _sums(noise, np.column_stack([down.T @ predicted, down.sum(axis=0)]))
        for index, found in ((at, sums), (noise_at, noise_sums)):
            self._step(1, m.target, index, found[:, :-1])
            self._step(3, m.bias, index, found[:, -1])
        for place, (symbols, vectors) in enumerate(zip(contexts, places, strict=True)):
            index, found = _sums(symbols, back * m.places[place])
            self._step(0, m.context, index, found)
            self._step(2, m.places, slice(place, place + 1), (back * vectors).sum(axis=0)[None, :])
        self.tokens += len(targets)


def contexts_of(targets: np.ndarray, end: int) -> np.ndarray:
    """The symbols before each token of one text, nearest first; the end before its start."""
    out = np.full((CONTEXT, len(targets)), end, targets.dtype)
    for place in range(CONTEXT):
        out[place, place + 1 :] = targets[: max(len(targets) - place - 1, 0)]
    return out


def text_symbols(text: str | None, symbols: Symbols, known: dict[bytes, int]) -> np.ndarray:
    """Symbols of a text's tokens; ``known`` remembers those of words met before."""
    found = words(text)
    for word in set(found).difference(known):
        known[word] = symbols.of(word)
    out = np.empty(len(found) + 1, np.int32)
    out[:-1] = [known[w] for w in found]
    out[-1] = symbols.end
    return out


def _trained(symbols: Symbols):
    """A function for tasks: train on the texts at hand, give the parameters and their weight."""

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trainer = None
        known: dict[bytes, int] = {}
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            for text in batch["text"]:
                targets = text_symbols(text, symbols, known)
                trainer = trainer or Trainer(Model.fresh(symbols), symbols, zlib.crc32(targets.tobytes()))
                waiting.append((contexts_of(targets, symbols.end), targets))
                held += len(targets)
                if held >= BATCH:
                    held = 0
                    _run(trainer, waiting)
            if len(known) > 1_000_000:
                known.clear()
        if trainer:
            _run(trainer, waiting)
            yield _rows(trainer)

    return train


def _run(trainer: Trainer, waiting: list[tuple[np.ndarray, np.ndarray]]) -> None:
    if waiting:
        contexts = np.concatenate([c for c, _ in waiting], axis=1)
        targets = np.concatenate([t for _, t in waiting])
        for start in range(0, len(targets), BATCH):
            trainer.batch(contexts[:, start : start + BATCH], targets[start : start + BATCH])
        waiting.clear()


VALUES = [f"v{k}" for k in range(DIMENSIONS + 1)]
ROWS = "row int, weight double, " + ", ".join(f"{v} double" for v in VALUES)


def _rows(trainer: Trainer) -> pd.DataFrame:
    """Parameters as rows: context, target with bias, places; each times the tokens seen."""
    m = trainer.model
    stacked = np.concatenate([m.context, m.target, m.places]).astype(float)
    bias = np.concatenate([np.zeros(len(m.bias)), m.bias, np.zeros(CONTEXT)])
    frame = pd.DataFrame(np.column_stack([stacked, bias]) * trainer.tokens, columns=VALUES)
    frame.insert(0, "weight", float(trainer.tokens))
    frame.insert(0, "row", np.arange(len(frame)))
    return frame


def fitted(docs: DataFrame, symbols: Symbols) -> Model:
    """The mean of the models that all tasks train, weighted by their tokens.

    What comes to the driver is one model, whose size is fixed.
    """
    parts = docs.select("text").mapInPandas(_trained(symbols), ROWS)
    sums = parts.groupBy("row").agg(F.sum("weight").alias("weight"), *[F.sum(v).alias(v) for v in VALUES])
    found = sums.toPandas().sort_values("row")
    if found.empty:
        return Model.fresh(symbols)
    mean = (found[VALUES].to_numpy() / found[["weight"]].to_numpy()).astype(np.float32)
    n = len(symbols.counts)
    vectors = mean[:, :-1]
    return Model(vectors[:n], vectors[n : 2 * n], vectors[2 * n :], mean[n : 2 * n, -1])


def chunked(docs: DataFrame) -> DataFrame:
    """Documents dealt to chunks by the hash of their id, each about what one task may hold."""
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(1 + size // CHUNK_CHARS)).alias("chunk")
    return docs.select("doc_id", "text", held_out("doc_id").alias("held_out"), chunk)


def word_counts(docs: DataFrame) -> DataFrame:
    """(chunk, word, n): every word of a chunk with its count in training texts."""

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        found: Counter[bytes] = Counter()
        seen: set[bytes] = set()
        for text, held in zip(batch["text"], batch["held_out"], strict=True):
            (seen if held else found).update(words(text))
        every = list(found) + list(seen.difference(found))
        n = [found.get(w, 0) for w in every]
        return pd.DataFrame({"chunk": batch["chunk"].iloc[0], "word": every, "n": n})

    return docs.groupBy("chunk").applyInPandas(count, "chunk long, word binary, n long")


def symbol_table(vocabulary: DataFrame, documents: int) -> Symbols:
    """The symbols of a vocabulary (word, c); at most some hundred rows come to the driver."""
    top = vocabulary.orderBy(F.col("c").desc(), "word").limit(TOP_WORDS).collect()
    names = {bytes(r["word"]): k for k, r in enumerate(top)}
    rest = vocabulary.where(~F.col("word").isin(*[bytearray(w) for w in names])) if names else vocabulary
    group = (F.crc32(F.substring("word", -2, 2)) % CLASSES).alias("g")
    sums = {r["g"]: r["c"] for r in rest.groupBy(group).agg(F.sum("c").alias("c")).collect()}
    counts = [r["c"] for r in top] + [documents] + [sums.get(g, 0) for g in range(CLASSES)]
    return Symbols(names, np.array(counts, float))


def normalisers(model: Model, symbols: Symbols, spark) -> np.ndarray:
    """log normaliser of every pair of context symbols, computed by tasks, a row each."""
    n = len(symbols.counts)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in batch["id"]:
                pair = np.stack([np.full(n, first), np.arange(n)])
                yield pd.DataFrame({"id": [first], "z": [model.log_normalisers(pair).tolist()]})

    found = spark.range(n).repartition(16).mapInPandas(rows, "id long, z array<double>").toPandas()
    return np.array(found.sort_values("id")["z"].tolist()).reshape(n, n).astype(np.float32)


def scored(docs: DataFrame) -> DataFrame:
    """Every document's log10 probability under a smoothed unigram base and under the model.

    Gives (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score). Words and an
    end make the tokens of a text; a null text has the end only. The base gives a token
    (c + 1) / (N + V + 1). The model gives the token's symbol a probability from the two
    symbols before it, normalised over all symbols, times the word's smoothed share of its
    class, so that all known words, one unknown word a class and the end sum to 1. Counts,
    classes and the model's training take in every document that is not held out; a null id
    is not held out. Repeated rows count and are scored each; an empty table gives no rows.
    Where there is nothing to learn from, all symbols are alike.
    """
    spark = docs.sparkSession
    parts = chunked(docs)
    found = stored(word_counts(parts), "words")
    vocabulary = found.groupBy("word").agg(F.sum("n").alias("c"))
    vocabulary = stored(vocabulary, "vocabulary")
    learned = vocabulary.where("c > 0")
    n_docs = docs.where(~held_out("doc_id")).count()
    n_words, n_distinct = learned.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, distinct = n_words + n_docs, n_distinct + (n_docs > 0)
    symbols = symbol_table(learned, n_docs)
    model = fitted(docs.where(~held_out("doc_id")), symbols)
    table = normalisers(model, symbols, spark)
    members = learned.groupBy((F.crc32(F.substring("word", -2, 2)) % CLASSES).alias("g")).agg(F.count("*").alias("m"))
    sizes = np.zeros(CLASSES)
    for row in members.collect():
        sizes[row["g"]] = row["m"]
    for word in symbols.top:
        sizes[word_class(word)] -= 1
    mass = symbols.counts[symbols.end + 1 :] + sizes + 1
    base_of = total + distinct + 1
    by_place = model.by_place()

    def score(key: tuple, texts: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        count = own["c"].to_numpy(float)
        names = own["word"].tolist()
        index = {word: k for k, word in enumerate(names)}
        symbol = np.fromiter((symbols.of(w) for w in names), np.int32, len(names))
        classed = symbol > symbols.end
        within = np.zeros(len(names))
        within[classed] = np.log10((count[classed] + 1) / mass[symbol[classed] - symbols.end - 1])
        base = np.log10((count + 1) / base_of)
        end_base = np.log10((n_docs + 1) / base_of)
        rows = []
        for doc_id, text, held in zip(texts["doc_id"], texts["text"], texts["held_out"], strict=True):
            at = np.array([index[w] for w in words(text)], np.int64)
            targets = np.append(symbol[at], symbols.end)
            contexts = contexts_of(targets, symbols.end)
            logs = -table[contexts[0], contexts[1]]
            for known_place, context in zip(by_place, contexts, strict=True):
                logs += known_place[context, targets]
            known = int((count[at] > 0).sum()) + (n_docs > 0)
            rows.append(
                (
                    doc_id,
                    held,
                    len(targets),
                    known,
                    total,
                    float(base[at].sum() + end_base),
                    float(logs.sum(dtype=float) / np.log(10) + within[at].sum()),
                )
            )
        return pd.DataFrame(rows, columns=SCORED).astype({"doc_id": "Int64"})

    counted = found.select("chunk", "word").join(vocabulary.hint("shuffle_hash"), "word")
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return parts.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInPandas(score, kind)


SCORED = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
