"""Benchmark passages in documents, found by CGK embedding and bit-sampling LSH.

Texts are sequences of lower-cased words. An item of n words counts as found if
d = floor(``DISTANCE`` * n) word edits or fewer turn it into some part of a
document. Windows are sized to the item (``SIZES``); items have one at every word
that leaves room for it, documents one at every word. A window of w words is
embedded by the CGK random walk of w steps: at step j the walk shows the word it
stands on and moves on if random bit j of that word is set, so that after an
insertion or a deletion two walks soon stand on the same words again, and edit
distance becomes Hamming distance. A repetition has its own random bits and samples
a few steps; windows that show the same words there are candidates. A walk that
stands on one word at two samples takes no part in that repetition, for it would
meet every window of that word.

``repetitions_for`` gives the number of repetitions: enough to reach ``RECALL``
for items of a size that one repetition proposes with the probability given in
``SIZES``, measured for the shortest items with all edits that ``DISTANCE``
allows, spread evenly, which was harder than edits at the start or anywhere. Longer items have more windows and
are found more surely. Items of so few words that no edit is allowed have one
window whose walk shows all of them, and are always found.

A proposed place is kept if at least n - d of the words around it are words of the
item, which holds at every place that the verifier accepts. Then places of one item in one
document that overlap are put together and verified: the word edit distance of the
whole item to the best place there, by dynamic programming. The distance is the
smallest among the places proposed.

The benchmark is held against the documents in blocks of a fixed number of
characters; only one block at a time is sent to the tasks. Null and empty texts
and items without words match nothing. Items with the same id are one item each
by text. Ties: the first place with the smallest distance. Repeated rows are each
compared; the result has one row for each pair of ids. Empty tables: no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from math import ceil, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_lake.llm.common import slices

DISTANCE = 0.2
#: The share of the worst items (see above) that the repetitions find.
RECALL = 0.999
#: Fewest words of an item, words of its windows, sampled steps, least share that one repetition proposes.
SIZES = ((10, 6, 3, 0.45), (5, 3, 2, 0.55))
#: Random bits of a word in a repetition, and the most steps of a walk.
STEPS = 8
#: Characters of benchmark text that tasks hold at a time.
BLOCK = 8_000_000
REMEMBERED = 500_000
#: Words of documents that are searched together, and that one numpy step covers.
STEP, CHUNK = 1 << 20, 1 << 15
#: Proposed places, and words around them, that one numpy step covers.
PLACES, AROUND = 1 << 18, 1 << 21

_WORD = re.compile(r"\w+")
_FOLD = 22  # bits of a key that the filters look at


def repetitions_for(recall: float, one: float) -> int:
    """Repetitions that find with probability ``recall`` what one finds with ``one``."""
    return max(1, ceil(log(1 - recall) / log(1 - one)))


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Windows(NamedTuple):
    """Windows of one size: their number of words, and the sampled steps of each repetition."""

    words: int
    samples: tuple[tuple[int, ...], ...]
    walks: bool = True  # else every step moves on


def windows_of(n: int, distance: float = DISTANCE) -> Windows:
    """The windows of an item of n words."""
    if int(distance * n) == 0:
        words = min(n, STEPS)
        return Windows(words, (tuple(range(words)),), walks=False)
    for least, words, count, hit in SIZES:
        if n >= least:
            break
    else:  # distances beyond a fifth let shorter items be edited
        words, count, hit = min(n, words), min(n, count), 0.2
    chosen = []
    for repetition in range(repetitions_for(RECALL, hit)):
        steps = np.random.default_rng([words, repetition]).permutation(words)[:count]
        chosen.append(tuple(sorted(map(int, steps))))
    return Windows(words, tuple(chosen))


class _Codes(dict):
    """Word -> 32-bit code, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        code = self[word] = zlib.crc32(word.encode())
        return code


def _joined(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    keys = (keys ^ more) * np.uint32(0x9E3779B1)
    keys ^= keys >> np.uint32(15)
    return keys


def _bits(words: np.ndarray, repetition: int) -> np.ndarray:
    """``STEPS`` random bits of each word, others in each repetition."""
    at, part = divmod(repetition, 64 // STEPS)
    x = words.astype(np.uint64) + np.uint64((at + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return ((x ^ x >> np.uint64(31)) >> np.uint64(STEPS * part)).astype(np.uint8)


def _keys(words: np.ndarray, windows: Windows, repetition: int) -> np.ndarray:
    """What the walk from each word shows at the sampled steps; 0 if it stands still between two.

    The walks from all words are taken together, last step first: the key of a
    walk at a word and step is that of the word it goes to, at the next step.
    """
    samples = windows.samples[repetition]
    bits = _bits(words, repetition) if windows.walks else np.full(len(words), 255, np.uint8)
    keys, after = np.full(len(words), windows.words, np.uint32), None
    for step in range(samples[-1], -1, -1):
        if after is not None:
            moved = np.zeros_like(keys)
            moved[:-1] = keys[1:]
            keys = np.where(bits & np.uint8(1 << step), moved, keys)
        if step in samples:
            shown = _joined(keys, words)
            if after is not None:
                between = np.uint8((1 << after) - (1 << step))
                shown[((bits & between) == 0) | (keys == 0)] = 0
            keys, after = shown, step
    return keys


def _filter(keys: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << _FOLD, bool)
    seen[keys & ((1 << _FOLD) - 1)] = True
    return seen


def _passes(seen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return seen[keys & ((1 << _FOLD) - 1)]


def _runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. count - 1 for each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class Index:
    """The windows of a block of items, by their size and repetition."""

    def __init__(self, items: list[tuple[int, list[str]]], distance: float = DISTANCE):
        known = _Codes()
        self.items = [(i, np.fromiter(map(known.__getitem__, w), np.int64, len(w))) for i, w in items if w]
        self.distance = distance
        self.lengths = np.array([len(c) for _, c in self.items], np.int64)
        self.slacks = np.array([int(distance * n) for n in self.lengths], np.int64)
        sizes = [windows_of(n, distance) for n in self.lengths.tolist()]
        #: How far from a proposed place an item can begin or end: its edits, and the lag of two walks.
        self.reach = self.slacks + np.array([s.words - 1 if s.walks else 0 for s in sizes], np.int64)
        self.windows: dict[Windows, list[tuple]] = {}
        if not self.items:
            return
        flat = np.concatenate([c for _, c in self.items]).astype(np.uint32)
        first = np.cumsum(self.lengths) - self.lengths
        for size in dict.fromkeys(sizes):
            own = np.array([number for number, s in enumerate(sizes) if s == size])
            counts = self.lengths[own] - size.words + 1
            owner, offset = np.repeat(own, counts), _runs(counts)
            self.windows[size] = []
            for repetition in range(len(size.samples)):
                keys = _keys(flat, size, repetition)[first[owner] + offset]
                order = np.argsort(keys, kind="stable")[(keys == 0).sum() :]
                self.windows[size].append((_filter(keys[order]), keys[order], owner[order], offset[order]))
        self.held = _filter(_joined(flat, np.repeat(np.arange(len(self.items)), self.lengths).astype(np.uint32)))

    def near(self, codes: np.ndarray, begins, ends, numbers: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which places have enough words of the item around them."""
        slack, reach = self.slacks[numbers], self.reach[numbers]
        low = np.maximum(begins, places - reach)
        counts = np.minimum(ends, places + self.lengths[numbers] + reach) - low
        kept = np.zeros(len(places), bool)
        steps = np.searchsorted(np.cumsum(counts), np.arange(0, counts.sum(), AROUND), "right")
        cuts = np.unique(np.append(steps, len(places)))
        for a, b in zip(cuts[:-1], cuts[1:]):
            size = counts[a:b]
            words = codes[np.repeat(low[a:b], size) + _runs(size)]
            held = _passes(self.held, _joined(words, np.repeat(numbers[a:b], size).astype(np.uint32)))
            found = np.add.reduceat(held, np.cumsum(size) - size, dtype=np.int64)
            kept[a:b] = found >= self.lengths[numbers[a:b]] - slack[a:b]
        return kept

    def candidates(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Columns document, item, place of the item's first word, in order, for texts put one after the other."""
        codes, begins = codes.astype(np.uint32, copy=False), np.concatenate([[0], ends[:-1]])
        rows = [np.empty((3, 0), np.int64)]
        for size, repetition, first in (
            (size, repetition, first)
            for size, tables in self.windows.items()
            for first in range(0, len(codes), CHUNK)
            for repetition in range(len(tables))
        ):
            seen, keys, owner, offset = self.windows[size][repetition]
            own = _keys(codes[first : first + CHUNK + size.words - 1], size, repetition)[:CHUNK]
            starts = np.flatnonzero(_passes(seen, own) & (own != 0))
            own = own[starts]
            low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            hit = high > low
            starts, low, counts = starts[hit] + first, low[hit], (high - low)[hit]
            docs = np.searchsorted(ends, starts, "right")
            # an entry of the index that meets very many words is dealt out as well
            total = int(counts.sum())
            upto = np.cumsum(counts)
            for a in range(0, total, PLACES):
                nth = np.arange(a, min(total, a + PLACES))
                at = np.searchsorted(upto, nth, "right")
                entry = low[at] + nth - (upto[at] - counts[at])
                found = np.unique(np.stack([docs[at], owner[entry], starts[at] - offset[entry]]), axis=1)
                near = self.near(codes, begins[found[0]], ends[found[0]], found[1], found[2])
                rows.append(found[:, near])
        return np.unique(np.concatenate(rows, axis=1), axis=1)


def edit_distance(item: np.ndarray, text: np.ndarray) -> int:
    """Smallest number of word edits that turn the item into some part of the text."""
    ramp = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for n, word in enumerate(item, start=1):
        below = np.empty_like(row)
        below[0] = n
        below[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        row = np.minimum.accumulate(below - ramp) + ramp  # words inserted one after another
    return int(row.min())


def matches(index: Index, codes: np.ndarray, ends: np.ndarray, distance: float) -> dict[tuple[int, int], int]:
    """(document, item) -> edit distance, for those that are near enough."""
    if distance > index.distance:
        raise ValueError("the index proposes pairs up to its own distance only")
    begins = np.concatenate([[0], ends[:-1]])
    docs, numbers, places = index.candidates(codes, ends)
    low = np.maximum(begins[docs], places - index.reach[numbers])
    high = np.minimum(ends[docs], places + index.lengths[numbers] + index.reach[numbers])
    # places are in order, so that those of one pair that overlap follow each other
    new = np.ones(len(docs), bool)
    new[1:] = (np.diff(docs) != 0) | (np.diff(numbers) != 0) | (low[1:] > high[:-1])
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(docs))[: len(firsts)] - 1
    best: dict[tuple[int, int], int] = {}
    for first, last in zip(firsts.tolist(), lasts.tolist()):
        pair = int(docs[first]), int(numbers[first])
        if best.get(pair) == 0:
            continue
        item, text = index.items[pair[1]][1], codes[low[first] : high[last]].astype(np.int64)
        slack = int(distance * len(item))
        if np.isin(item, text).sum() < len(item) - slack:
            continue
        found = edit_distance(item, text)
        if found <= slack:
            best[pair] = min(found, best.get(pair, found))
    return best


def _search(shared, distance: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = Index(*shared.value), _Codes()

        def found(ids: list, parts: list[np.ndarray]) -> pa.RecordBatch:
            codes, ends = np.concatenate(parts).astype(np.uint32), np.cumsum([*map(len, parts)])
            rows = [
                (ids[doc], index.items[number][0], d, len(index.items[number][1]))
                for (doc, number), d in matches(index, codes, ends, distance).items()
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                ["doc_id", "item_id", "edit_distance", "item_words"],
            )

        ids, parts, size = [], [], 0
        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = words_of(text)
                ids.append(doc_id)
                parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                size += len(words)
                if size >= STEP:
                    yield found(ids, parts)
                    ids, parts, size = [], [], 0
        if parts:
            yield found(ids, parts)

    return search


def contaminated(
    docs: DataFrame, benchmark: DataFrame, distance: float = DISTANCE
) -> DataFrame:
    """(doc_id, item_id, edit_distance, item_words, similarity) for each document that holds an item."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks, result = max(1, ceil(size / BLOCK)), None
    for block in range(blocks):
        # a block holds about BLOCK characters of the benchmark
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().collect()
        listed = [(r["item_id"], words_of(r["text"])) for r in sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
        shared = spark.sparkContext.broadcast((listed, distance))
        found = rows.mapInArrow(
            _search(shared, distance), "doc_id long, item_id long, edit_distance long, item_words long"
        )
        result = found if result is None else result.union(found)
    return (
        result.groupBy("doc_id", "item_id")
        .agg(F.min_by("edit_distance", F.struct("edit_distance", "item_words")).alias("edit_distance"),
             F.min_by("item_words", F.struct("edit_distance", "item_words")).alias("item_words"))
        .withColumn("similarity", 1 - F.col("edit_distance") / F.col("item_words"))
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item.

    Rows that share an id but not the text are judged one by one. Rows with a null
    id are kept.
    """

    def key(doc_id: Column, text: Column) -> Column:
        return F.when(doc_id.isNotNull(), F.xxhash64(doc_id.cast("long"), text.cast("string")))

    keyed = docs.select(key(F.col("doc_id"), F.col("text")).alias("doc_id"), "text")
    found = contaminated(keyed, benchmark).select(F.col("doc_id").alias("bad_key")).distinct()
    return docs.join(found, key(docs["doc_id"], docs["text"]) == found["bad_key"], "left_anti")
