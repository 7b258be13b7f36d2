"""Quality rules: statistics of every text, and an isolation forest over them."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
WHITE = b"\t\n\x0b\x0c\r "

# Rows with a label, least hash first: on every other one the forests are fitted, without its
# label, and on those between their thresholds are set.
LABELLED_ROWS = 8192
TREES = 100
SEED = 42

# Rows of a tree's sample: few, so that junk of one kind, of which there are many rows, does not
# look usual to it.
SAMPLE = 4

# Share of labelled good documents that the threshold of one forest may reject at most.
MAX_FALSE = 0.0005

# Probability with which the bad rows that a threshold finds may be ahead by chance.
CHANCE = 0.001

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_twins",
)
COUNT_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows found twice or more, the first one included."""
    windows = list(zip(*(words[i:] for i in range(window)), strict=False))
    found = Counter(windows)
    if len(found) == len(windows):
        return 0
    repeats = np.fromiter((found[w] > 1 for w in windows), bool, len(windows))
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(repeats), 1)
    np.add.at(edges, np.flatnonzero(repeats) + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one text; all 0 for null."""
    raw = (text or "").encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.split()]
    white = len(raw) - len(raw.translate(None, WHITE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    twins = sum(map(bytes.__eq__, words, words[1:]))
    return (
        len(words),
        len(text or "") - white,
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        twins,
    )


def count_frame(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_counts(t) for t in texts], columns=list(COUNTS)).astype("int64")


def base_failed(counts: pd.DataFrame) -> pd.Series:
    few = counts["n_words"] < MIN_WORDS
    return few | (100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * counts["n_words"])


def features(counts: pd.DataFrame) -> np.ndarray:
    """Symbols, letters, repeated words and twins a word, the share of repeated lines, and the
    logarithm of the words. What is usual for them is left to the labelled rows."""
    words = counts["n_words"].clip(lower=1)
    rates = [
        counts["n_symbols"] / words,
        (counts["word_chars"] - counts["n_symbols"]) / words,
        counts["n_dup_lines"] / counts["n_lines"].clip(lower=1),
        counts["n_repeat_words"] / words,
        counts["n_twins"] / words,
        np.log1p(counts["n_words"]),
    ]
    return np.column_stack(rates).astype(float)


@dataclass
class Tree:
    """Nodes in arrays; a leaf has feature -1 and the path length that it stands for."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray


def mean_path(n: int) -> float:
    """Mean length of a search in a binary tree of n points that finds nothing."""
    if n < 2:
        return 0.0
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


def grow(points: np.ndarray, rng: np.random.Generator, height: int) -> Tree:
    """Split a random feature at a random place between its least and greatest value."""
    nodes: list[list[float]] = []

    def add(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        values = points[rows]
        nodes.append([-1, 0.0, -1, -1, depth + mean_path(len(rows))])
        low, high = values.min(axis=0), values.max(axis=0)
        wide = np.flatnonzero(high > low)
        if depth < height and len(wide):
            axis = rng.choice(wide)
            split = rng.uniform(low[axis], high[axis])
            below = values[:, axis] <= split
            left, right = add(rows[below], depth + 1), add(rows[~below], depth + 1)
            nodes[at][:4] = [int(axis), split, left, right]
        return at

    add(np.arange(len(points)), 0)
    columns = list(zip(*nodes, strict=True))
    ints = [np.array(columns[k], np.int64) for k in (0, 2, 3)]
    return Tree(ints[0], np.array(columns[1]), ints[1], ints[2], np.array(columns[4]))


@dataclass
class Forest:
    trees: list[Tree]
    sample: int
    threshold: float = np.inf

    def scores(self, points: np.ndarray) -> np.ndarray:
        """2^(-mean path length / expected length): near 1 for points soon set apart."""
        total = np.zeros(len(points))
        rows = np.arange(len(points))
        for tree in self.trees:
            node = np.zeros(len(points), np.int64)
            while True:
                feature = tree.feature[node]
                inner = feature >= 0
                if not inner.any():
                    break
                low = points[rows, np.where(inner, feature, 0)] <= tree.split[node]
                node = np.where(inner, np.where(low, tree.left[node], tree.right[node]), node)
            total += tree.length[node]
        return 2.0 ** (-total / max(len(self.trees), 1) / max(mean_path(self.sample), 1.0))


def fit_forest(points: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
    """Trees over random samples of the rows; no label has a part in it."""
    rng = np.random.default_rng(seed)
    sample = min(sample, len(points))
    if not sample:
        return Forest([], 0)
    height = int(np.ceil(np.log2(max(sample, 2))))
    grown = [grow(points[rng.choice(len(points), sample, replace=False)], rng, height) for _ in range(trees)]
    return Forest(grown, sample)


@dataclass
class Steps:
    """The scores of a forest over one statistic, which are steps, and its threshold."""

    breaks: np.ndarray
    scores: np.ndarray
    threshold: float

    @classmethod
    def of(cls, forest: Forest) -> Steps:
        splits = [t.split[t.feature >= 0] for t in forest.trees]
        breaks = np.unique(np.concatenate([np.zeros(0), *splits]))
        return cls(breaks, forest.scores(np.append(breaks, np.inf)[:, None]), forest.threshold)

    def of_points(self, points: np.ndarray) -> np.ndarray:
        return self.scores[np.searchsorted(self.breaks, points)]


@dataclass
class Forests:
    """An isolation forest for how far each feature is above, and how far below, its middle.

    How short a text may be is for the base rules, so there is none for the last feature below.
    What is rare in one feature does so not hide behind what is rare in another, and a
    threshold tells for each how rare is bad. A text is rejected where any score passes its
    threshold.
    """

    middle: np.ndarray
    steps: list[Steps]

    def sides(self, points: np.ndarray) -> np.ndarray:
        off = points - self.middle
        return np.column_stack([np.maximum(off, 0), np.maximum(-off[:, :-1], 0)])

    def scores(self, points: np.ndarray) -> np.ndarray:
        """One column a statistic."""
        sides = self.sides(points)
        return np.column_stack([s.of_points(sides[:, k]) for k, s in enumerate(self.steps)])

    def margin(self, points: np.ndarray) -> np.ndarray:
        """The greatest score as a share of its threshold; above 1 the text is rejected."""
        if not self.steps or not len(points):
            return np.zeros(len(points))
        return (self.scores(points) / np.array([s.threshold for s in self.steps])).max(axis=1)


def fit_forests(points: np.ndarray) -> Forests:
    """The forests of all rows, whatever their labels, without thresholds."""
    if not len(points):
        return Forests(np.zeros(0), [])
    forests = Forests(np.median(points, axis=0), [])
    sides = forests.sides(points)
    forests.steps = [Steps.of(fit_forest(sides[:, [k]], seed=SEED + k)) for k in range(sides.shape[1])]
    return forests


def calibrated(scores: np.ndarray, good: np.ndarray, max_false: float = MAX_FALSE) -> float:
    """The threshold that finds most bad rows while at most a share of the good ones passes it.

    It lies in the gap between two scores, near that of a bad row: what is between them is
    rather kept. Where so many bad rows could be ahead of the good ones by chance, or there are
    no rows of both kinds, no score passes.
    """
    if good.all() or not good.any():
        return np.inf
    allowed = int(max_false * good.sum())
    limit = np.sort(scores[good])[::-1][allowed]
    above = scores[(scores > limit) & ~good]
    if not len(above) or np.mean(~good) ** len(above) > CHANCE:
        return np.inf
    return limit + 0.9 * (above.min() - limit)


def labelled(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> pd.DataFrame:
    """Counts and quality of a bounded sample of documents with a label."""
    known = labels.where("doc_id is not null and quality is not null")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    counted = joined.select("doc_id", "quality", counts_of(joined["text"]).alias("c"))
    found = counted.select("doc_id", "quality", "c.*").orderBy(F.xxhash64("doc_id"), *COUNTS).limit(rows)
    return found.toPandas()


def trained(points: np.ndarray, good: np.ndarray, max_false: float = MAX_FALSE) -> Forests:
    """Forests of every other row, with thresholds from the labels of those between."""
    forests = fit_forests(points[::2])
    held = points[1::2]
    if forests.steps and len(held):
        scores = forests.scores(held)
        for k, steps in enumerate(forests.steps):
            steps.threshold = calibrated(scores[:, k], good[1::2], max_false)
    return forests


def fitted(docs: DataFrame, labels: DataFrame, max_false: float = MAX_FALSE) -> Forests:
    """Forests over labelled documents with the thresholds that their labels give."""
    sample = labelled(docs, labels)
    sample = sample[~base_failed(sample)]
    return trained(features(sample), sample["quality"].to_numpy() > 0, max_false)


def counts_of(text: Column) -> Column:
    return F.pandas_udf(count_frame, COUNT_TYPE)(text)


def verdicts(text: Column, forests: Forests) -> Column:
    """The counts of a text with ``base_failed``, ``score`` and ``kept``."""

    def judge(texts: pd.Series) -> pd.DataFrame:
        found = count_frame(texts)
        score = forests.margin(features(found))
        failed = base_failed(found)
        return found.assign(base_failed=failed, score=score, kept=~failed & (score <= 1))

    kind = COUNT_TYPE[:-1] + ",base_failed:boolean,score:double,kept:boolean>"
    return F.pandas_udf(judge, kind)(text)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of every document, over its whole text.

    Lines count with a word only, and equal ones by their exact text. ``kept`` is false where
    the base rules fail (under 20 words, or more than 30 of 100 words in repeated windows)
    or the score of a forest passes its threshold; ``score`` is the greatest of these as a share
    of its threshold. Null and empty texts have no words and fail.
    Repeated rows are judged each; an empty table gives no rows; without labels, or with
    labels of one kind only, the base rules alone decide. Labels that disagree count as the
    worse one. At most 8,192 labelled rows, least hash of the id first, come to the driver.
    """
    forests = fitted(docs, labels)
    rows = docs.select("doc_id", verdicts(docs["text"], forests).alias("v"))
    return rows.select("doc_id", "v.*")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``judged`` keeps, with their own columns."""
    forests = fitted(docs.select("doc_id", "text"), labels)
    marked = docs.withColumn("__verdict", verdicts(docs["text"], forests))
    return marked.where("__verdict.kept").drop("__verdict")
