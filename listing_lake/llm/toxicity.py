"""Toxicity by class-conditional Kneser-Ney models over words.

P(word | class) = max(n - D, 0) / N + (D T / N) P(word), with the counts n, N and
T (distinct words) of that class, its absolute discount D, and one backoff
distribution P for both classes: a word's share of continuation counts, the number
of distinct documents that hold it, over *all* documents, labelled or not. A
rare expression so gets nearly the same probability from both classes.

A text is compared by its length-normalised log-likelihoods under the toxic and
the ordinary class: over the whole text, over the passage of ``WINDOW`` words
where they differ most, and over its most telling words, since a few insults in
a long text would vanish in the mean. Chance gives longer texts more telling
words, so their share and the length count too. A logistic calibration turns
these figures into a score; it is fitted on labelled rows that took no part in
the counts.

Words are counted by 64-bit hashes, so that no two words share a count. A word that
no labelled text has is as likely in both classes up to a constant, so the
model holds the words of the labelled texts only, 12 bytes each. At most about
``LABELS`` labelled rows are learned from (a hash of the id chooses them);
everything else covers all rows. Labels of held-out documents
(crc32 of the id mod 4 is 2) are never read.

Null texts count as empty; texts without words get the score of a text with no
evidence. A document labelled twice counts as toxic if one label says so; null
labels do not count. Without labels of both classes the score is a constant.
Repeated rows each get a row; an empty table gives none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listing_lake.llm.calibration import Logistic
from listing_lake.llm.common import bounded, held_out, slices
from listing_lake.session import stored

#: The share of one document that a word never seen gets.
UNSEEN = 2.0**-22
LABELS = 1_000_000
WINDOW = 25
CUTOFF = 0.3
#: Log-ratio from which a word is telling.
TELLING = 4.0
#: Words a worker remembers, and distinct words it counts before it hands them on.
REMEMBERED, COUNTED = 500_000, 1_000_000

_WORD = re.compile(r"[^\W\d_]+")
FEATURES = ("mean", "passage", "word", "three", "six", "distinct", "telling", "length")


def _key(word: str) -> int:
    """A signed 64-bit hash."""
    key = xxhash.xxh64_intdigest(word)
    return key - (key >> 63 << 64)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each class and documents of each word, one row for each hash."""
    ordinary, toxic, held = Counter(), Counter(), Counter()

    def out() -> pa.RecordBatch:
        table: dict[int, list[int]] = {}
        for place, counter in enumerate((ordinary, toxic, held)):
            for word, n in counter.items():
                table.setdefault(_key(word), [0, 0, 0])[place] += n
            counter.clear()
        values = np.array(list(table.values()), np.int64).reshape(-1, 3)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(table), pa.int64()), *(pa.array(values[:, i]) for i in range(3))],
            ["word", "ordinary", "toxic", "held"],
        )

    for part in slices(batches):
        for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            words = words_of(text)
            held.update(set(words))
            if label is not None:
                (toxic if label else ordinary).update(words)
        if len(held) > COUNTED:
            yield out()
    yield out()


class Ratios(NamedTuple):
    """Log-ratios of the class probabilities beside sorted hashes of their words; one for all other words."""

    words: np.ndarray
    ratios: np.ndarray
    unseen: float


def _ratios(counts: DataFrame) -> Ratios:
    sums = ["sum(held) AS held"]
    for c in ("ordinary", "toxic"):
        sums += [
            f"sum({c}) AS {c}_n",
            f"count_if({c} > 0) AS {c}_types",
            f"count_if({c} = 1) AS {c}_once",
            f"count_if({c} = 2) AS {c}_twice",
        ]
    total = counts.agg(*map(F.expr, sums)).first().asDict()
    if not total["ordinary_n"] or not total["toxic_n"]:
        return Ratios(np.empty(0, np.int64), np.empty(0, np.float32), 0.0)
    # one more document is spread over words never seen
    backoff = (F.col("held") + UNSEEN) / float(total["held"] + 1)

    def probability(c: str):
        own = F.greatest(F.col(c) - _discount(total, c), F.lit(0.0)) / float(total[f"{c}_n"])
        return own + backoff * _weight(total, c)

    ratio = F.log(probability("toxic") / probability("ordinary"))
    # the words of at most about LABELS texts, 12 bytes each
    labelled = counts.filter("ordinary > 0 OR toxic > 0")
    found = labelled.select("word", ratio.cast("float").alias("ratio")).toArrow()
    words, ratios = found.column("word").to_numpy(), found.column("ratio").to_numpy()
    order = np.argsort(words)
    unseen = np.log(_weight(total, "toxic") / _weight(total, "ordinary"))
    return Ratios(words[order], ratios[order], float(unseen))


def _discount(total: dict, c: str) -> float:
    once, twice = total[f"{c}_once"], total[f"{c}_twice"]
    return once / (once + 2 * twice) if once and twice else 0.75


def _weight(total: dict, c: str) -> float:
    """What the discounts leave to the backoff distribution."""
    return _discount(total, c) * total[f"{c}_types"] / total[f"{c}_n"]


class _Known(dict):
    """Word -> log-ratio, remembered up to a bound."""

    def __init__(self, model: Ratios):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        words, key = self.model.words, np.int64(_key(word))
        at = int(words.searchsorted(key))
        value = float(self.model.ratios[at]) if at < len(words) and words[at] == key else self.model.unseen
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value
        return value


def figures(words: list[str], known: dict[str, float]) -> tuple[float, ...]:
    """The features of one text, see FEATURES; zeros without words."""
    if not words:
        return (0.0,) * len(FEATURES)
    x = np.fromiter(map(known.__getitem__, words), float, len(words))
    sums = np.concatenate([[0.0], np.cumsum(x)])
    width = min(len(x), WINDOW)
    top = np.sort(np.partition(x, len(x) - min(6, len(x)))[-6:])
    distinct = set(words)
    own = np.fromiter(map(known.__getitem__, distinct), float, len(distinct))
    return (
        sums[-1] / len(x),
        (sums[width:] - sums[:-width]).max() / width,
        top[-1],
        top[-3:].sum(),
        top.sum(),
        np.partition(own, len(own) - min(3, len(own)))[-3:].sum(),
        (x > TELLING).sum() / len(x) ** 0.5,
        np.log(len(x)),
    )


def _measure(model):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(model.value)
        for part in slices(batches):
            found = [figures(words_of(text), known) for text in part.column(0).to_pylist()]
            values = np.array(found, float).reshape(-1, len(FEATURES))
            kept = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in kept] + [pa.array(values[:, i]) for i in range(len(FEATURES))],
                kept + list(FEATURES),
            )

    return measure


def _apply(model: Logistic):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            values = np.column_stack([part.column(n).to_numpy() for n in FEATURES])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("version"), part.column("held_out"), pa.array(model(values))],
                ["doc_id", "version", "held_out", "score"],
            )

    return apply


def score(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs (doc_id, text).

    labels: (doc_id, toxic).
    """
    return _scored(docs, labels, cutoff).drop("version")


def _scored(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The same with a hash of the text, since rows may share an id."""
    spark = docs.sparkSession
    marked = bounded(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic")),
        LABELS,
    ).withColumnRenamed("doc_id", "marked_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # one side has at most about LABELS rows of two numbers
    rows = rows.join(F.broadcast(marked), F.col("doc_id") == F.col("marked_id"), "left").select(
        "doc_id",
        "text",
        F.xxhash64("text").alias("version"),
        held_out().alias("held_out"),
        "toxic",
        (F.shiftright(F.crc32(F.col("doc_id").cast("string")), 2) % 4 == 3).alias("aside"),
    )
    counts = stored(
        rows.select("text", F.when(~F.col("aside"), F.col("toxic")).alias("toxic"))
        .mapInArrow(_count, "word long, ordinary long, toxic long, held long")
        .groupBy("word")
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"), F.sum("held").alias("held"))
    )
    ratios = _ratios(counts)
    shape = ", ".join(f"{name} double" for name in FEATURES)
    measured = stored(
        rows.select("text", "doc_id", "version", "held_out", F.when(F.col("aside"), F.col("toxic")).alias("toxic")).mapInArrow(
            _measure(spark.sparkContext.broadcast(ratios)),
            f"doc_id long, version long, held_out boolean, toxic int, {shape}",
        )
    )
    known = measured.filter("toxic IS NOT NULL").select("toxic", *FEATURES).toArrow()
    model = Logistic(
        np.column_stack([known.column(n).to_numpy() for n in FEATURES]), known.column("toxic").to_numpy() > 0
    )
    return measured.mapInArrow(
        _apply(model), "doc_id long, version long, held_out boolean, score double"
    ).withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted to be toxic.

    Rows that share an id but not the text are judged one by one. Rows with a null
    id are kept.
    """
    bad = _scored(docs, labels).filter("predicted = 1")
    found = bad.select(F.col("doc_id").alias("bad_id"), F.col("version").alias("bad_version")).distinct()
    same = (docs["doc_id"].cast("long") == found["bad_id"]) & (
        F.xxhash64(docs["text"].cast("string")) == found["bad_version"]
    )
    return docs.join(found, same, "left_anti")
