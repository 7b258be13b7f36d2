"""Periodic runs of words: seeds by k-grams, diagonals extended once, repeats collapsed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ratewatch.llm.text import byte_slices

MIN_WORDS = 12

# Bytes of text that are searched at once; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20

# Neighbouring chains of one k-gram that can hold a partner: they are more than k / 2 apart,
# and lags stay below 2 k.
CHAIN_REACH = 3

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of all texts in a row, and where each text's words begin and the last ones end."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    values, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    there = pc.greater(pc.binary_length(values), 0)
    before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    return before[ends - ends[0]], values.filter(there)


def _named(keys: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and groups of what occurs again in its document, in order of group and place."""
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    other = np.ones(len(at), bool)
    other[1:] = (keys[1:] != keys[:-1]) | (doc[at[1:]] != doc[at[:-1]])
    first = np.flatnonzero(other)
    sizes = np.diff(np.append(first, len(at)))
    again = np.repeat(sizes > 1, sizes)
    return at[again], np.repeat(np.arange((sizes > 1).sum()), sizes[sizes > 1])


def _pairs(at: np.ndarray, group: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, position) for occurrences of one k-gram that are ``least`` to 2 k - 1 words apart.

    Occurrences up to k / 2 apart form a chain: they are in arithmetic progression by the
    k-gram's own period p, inside one run of that period. Between two chains each lag needs one
    pair only, and all lags differ by multiples of p. So a run's k-grams are never paired with
    each other, and a word repeated n times costs n steps and not the square.
    """
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.ones(len(at), bool)
    begins[1:] = (group[1:] != group[:-1]) | (np.diff(at) > k // 2)
    first = np.flatnonzero(begins)
    n = np.diff(np.append(first, len(at)))
    low, high, group = at[first], at[first + n - 1], group[first]
    step = (high - low) // np.maximum(n - 1, 1)
    inside = (n > 1) & (step >= least)
    lags, places = [step[inside]], [low[inside]]
    for reach in range(1, CHAIN_REACH + 1):
        a = np.flatnonzero(group[reach:] == group[:-reach])
        b = a + reach
        base = low[b] - high[a]
        p = np.maximum(step[a], step[b])
        by = np.maximum(p, 1)
        begin = np.maximum(0, -((base - least) // by))
        end = np.minimum(n[a] + n[b] - 2, (2 * k - 1 - base) // by)
        many = np.maximum(0, end - begin + 1)
        row = np.repeat(np.arange(len(a)), many)
        m = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        lags.append(base[row] + m * p[row])
        places.append(high[a][row] - np.minimum(m, n[a][row] - 1) * p[row])
    return np.concatenate(lags), np.concatenate(places)


def _stretch(words: np.ndarray, lag: int, low: int, high: int) -> tuple[int, int]:
    """The whole stretch of places x around [low, high) where words x and x + lag are equal."""
    size = 32
    while high + lag < len(words):
        end = min(high + size, len(words) - lag)
        differ = np.flatnonzero(words[high:end] != words[high + lag : end + lag])
        if len(differ):
            high += int(differ[0])
            break
        high, size = end, size * 4
    size = 32
    while low > 0:
        begin = max(0, low - size)
        differ = np.flatnonzero(words[begin:low] != words[begin + lag : low + lag])
        if len(differ):
            low = begin + int(differ[-1]) + 1
            break
        low, size = begin, size * 4
    return low, high


def _extended(words: np.ndarray, lags: np.ndarray, places: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(lag, low, high) of the diagonals through the seeds, each diagonal once.

    The table holds, per lag, how far its diagonals have been followed; seeds before that are
    left out. Those whose k-gram overlaps the seed before are left out beforehand.
    """
    seeds = np.unique(lags * len(words) + places)
    lags, places = seeds // len(words), seeds % len(words)
    fresh = np.ones(len(seeds), bool)
    fresh[1:] = (lags[1:] != lags[:-1]) | (np.diff(places) > k)
    covered: dict[int, int] = {}
    for lag, place in zip(lags[fresh].tolist(), places[fresh].tolist(), strict=True):
        if place < covered.get(lag, 0):
            continue
        low, high = _stretch(words, lag, place, place + k)
        covered[lag] = high
        yield lag, low, high


def runs_in(words: np.ndarray, doc: np.ndarray, least: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all maximal runs, by start and then period.

    ``words`` are numbers of words, those of all documents in a row with a number of its own
    between two documents; ``doc`` is the document of every word, in order, and -1 between.
    A run of period q and L >= max(least, 2 q) words overlaps itself, moved by q, in L - q
    words. That is at least ``least / 2``, and q itself, so a k-gram with k between them occurs
    q words apart: for k = least / 2 all q < 2 k, and for every doubling of k all q from k on.
    """
    k = (least + 1) // 2
    at = np.flatnonzero(doc >= 0)
    at, group = _named(words[at], at, doc)
    width, found, nothing_below = 1, [], 1
    while len(at):
        # Names of longer k-grams are pairs of names of shorter ones.
        while width < k and len(at):
            wider = min(2 * width, k)
            names = np.full(len(words) + 1, -1, np.int64)
            names[at] = group
            at = np.sort(at)
            there = at + (wider - width)
            there[there > len(words)] = len(words)
            both = names[there] >= 0
            at, there = at[both], there[both]
            at, group = _named(names[at] * (len(group) + 1) + names[there], at, doc)
            width = wider
        lags, places = _pairs(at, group, k, nothing_below)
        for lag, low, high in _extended(words, lags, places, k):
            if high - low + lag >= max(least, 2 * lag):
                found.append((low, high - low + lag, lag))
        k *= 2
        nothing_below = k
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.array(found, np.int64)
    # The same stretch also repeats with multiples of its period; the smallest comes first.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def searched(texts: pa.Array, least: int = MIN_WORDS) -> tuple[pa.Array, pa.Array]:
    """Runs of every text, and its words without the repeats, joined by one space."""
    offsets, values = split_words(texts)
    counts = np.diff(offsets)
    # One free place after every document, so that no run goes from one to the next.
    place = np.arange(len(values)) + np.repeat(np.arange(len(counts)), counts)
    words = -1 - np.arange(len(values) + len(counts), dtype=np.int64)
    words[place] = values.dictionary_encode().indices.to_numpy()
    doc = np.full(len(words), -1, np.int64)
    doc[place] = np.repeat(np.arange(len(counts)), counts)
    runs = runs_in(words, doc, least)
    owner = doc[runs[:, 0]]
    start, length, period = runs[:, 0] - (offsets[:-1] + np.arange(len(counts)))[owner], runs[:, 1], runs[:, 2]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(counts)))]).astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(RUNS.value_type))
    drops = np.zeros(len(words) + 1, np.int64)
    np.add.at(drops, runs[:, 0] + period, 1)
    np.add.at(drops, runs[:, 0] + length, -1)
    keep = (np.cumsum(drops)[:-1] == 0)[place]
    left = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(left), values.filter(pa.array(keep)))
    return pa.ListArray.from_arrays(pa.array(bounds), rows, type=RUNS), pc.binary_join(lists, " ")


def collapsed(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, text): the periodic runs of every text, and it without the repeats.

    A run is a stretch of words with a smallest period q, so that words q apart are the same
    bytes, of at least ``least`` and 2 q words, that no word beside it continues. ``runs``
    holds start, length and period by start and then period; runs may overlap. The text keeps
    the words that no run has after its first q, joined by one space.

    Every document is a row of its own, so repeated rows and null ids give rows of their own;
    null, empty and blank texts have no word and no run and become empty; other columns are
    left out; an empty table gives no rows. There is no shuffle. A document is searched as a
    whole, in memory and time near to its length; documents share a slice of a few MB.
    """
    kept = docs.select("doc_id", "text")
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, n_words long, "
    schema += "runs array<struct<start:long,length:long,period:long>>, text string"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text", SLICE_BYTES):
            texts = part.column("text")
            counts = np.diff(split_words(texts)[0])
            runs, left = searched(texts, least)
            columns = [part.column("doc_id"), pa.array(counts), runs, left]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "text"])

    return kept.mapInArrow(search, schema)
