"""Quality scores by co-training two views of a document.

The text view sees figures of the whole text (shares of character and word
classes, repetition, line and word lengths, a hashed histogram of character
pairs). The metadata view sees source, language, the stated number of characters
and whether they are missing, never the text: the most frequent sources and
languages of all documents have a place each, rarer ones share some by hash. Each view
has a logistic classifier, first fitted on the labels. In each round both
score every unlabelled document. Of each class, the documents that a view is
surest about, ``HANDED`` of them all more in every round, go to the *other* view as
pseudo-labels, which takes steps on labels and pseudo-labels together. Those
of a class weigh at most as much as its labels, so that neither view forgets them.
At the end each view is calibrated on labelled documents that took no part, and a
logistic model of both calibrated views scores all documents.

The unlabelled documents stay distributed: a round counts their scores by bins,
sets its limits from these counts (a bin is taken whole), and adds up gradients and
curvatures of all that were handed over; only these sums reach the driver. At most about
``LABELS`` labelled documents are learned from, chosen by a hash of the id; labels of held-out
documents (crc32 of the id mod 4 is 2) are never read, nor are these handed over.
Features and scores cover all rows and whole texts.

Null texts count as empty, null metadata is a value of its own. A document
labelled twice counts as good only if all labels say so; null labels do not
count. Without labels of both classes the score is a constant. Repeated rows each
get a row; an empty table gives none.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from math import ceil, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listing_lake.llm.calibration import Logistic
from listing_lake.llm.common import bounded, fold, held_out, slices
from listing_lake.session import stored

LABELS = 20_000
#: Exchanges, steps of a view in each, and steps on the labels alone before them.
ROUNDS, STEPS, FIRST = 4, 2, 60
#: Share of the unlabelled documents that a view hands over in the first round, of both
#: classes together; twice as many in the second, and so on.
HANDED = 0.05
#: How sure a view must be of a pseudo-label if both classes were equally frequent: a view
#: that only knows the frequent class is sure of nothing.
SURE = 0.9
RIDGE = 1.0
PAIRS = 48
#: Values of a column with a place of their own, and places that the others share.
SOURCES, LANGS = (48, 16), (24, 8)
#: Scores are counted by log-odds, from -LIMIT to LIMIT, in bins of 1 / FINE.
LIMIT, FINE = 20, 32
#: Standard deviations that a figure may be off.
FAR = 8.0

_CLASSES = tuple(re.compile(p) for p in (r"[^\W\d_]+", r"[A-ZÀ-Þ]+", r"\d+", r"[#$%&*@^~|<>{}\[\]\\/=+_]+", r"[.,;:]+", r"[!?]+"))


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def text_figures(text: str | None) -> np.ndarray:
    text = text or ""
    size = len(text)
    words, lines = text.split(), text.split("\n")
    runs = [p.findall(text) for p in _CLASSES]
    counts, line_counts = Counter(words), Counter(lines)
    common = counts.most_common(5)
    plain = [
        np.log1p(size),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        *(_share(sum(map(len, r)), size) for r in runs),
        *(_share(len(r), len(words)) for r in runs),
        _share(sum(map(len, words)), len(words)),
        _share(len(counts), len(words)),
        _share(sum(n for _, n in common), len(words)),
        _share(sum(n for _, n in line_counts.items() if n > 1), len(lines)),
        _share(len(words), len(lines)),
        _share(sum(len(w) == 1 for w in words), len(words)),
        _share(sum(not w[-1].isalnum() for w in words), len(words)),
        _share(sum(w.isupper() for w in words), len(words)),
    ]
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    pairs = np.bincount((codes[:-1] * 31 + codes[1:]) % PAIRS, minlength=PAIRS) if size > 1 else np.zeros(PAIRS)
    return np.concatenate([plain, pairs / max(1, size - 1)])


class Places(NamedTuple):
    """Where the values of a column stand: own places first, then shared ones."""

    own: dict[str, int]
    shared: int

    @property
    def size(self) -> int:
        return len(self.own) + self.shared

    def __call__(self, value: str) -> int:
        return self.own.get(value, len(self.own) + zlib.crc32(value.encode()) % self.shared)


def meta_figures(source: str | None, lang: str | None, n_chars: int | None, places: tuple[Places, Places]) -> np.ndarray:
    by_source, by_lang = places
    found = np.zeros(by_source.size + by_lang.size + 4)
    if source is not None:
        found[by_source(source)] = 1
    if lang is not None:
        found[by_source.size + by_lang(lang)] = 1
    found[-4:] = source is None, lang is None, n_chars is None, np.log1p(max(0, n_chars or 0))
    return found


def _figures(places: tuple[Places, Places]):
    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            given = {n: part.column(n).to_pylist() for n in ("text", "source", "lang", "n_chars")}
            text = [text_figures(t).astype("f4") for t in given["text"]]
            meta = [
                meta_figures(*m, places).astype("f4") for m in zip(given["source"], given["lang"], given["n_chars"])
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("quality")]
                + [pa.array(v, pa.list_(pa.float32())) for v in (text, meta)],
                ["doc_id", "quality", "by_text", "by_meta"],
            )

    return figures


def _squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


class Line(NamedTuple):
    """A logistic classifier of one view."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def design(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((np.asarray(features, float) - self.mean) / self.scale, -FAR, FAR)
        return np.column_stack([np.ones(len(x)), x])

    def odds(self, features: np.ndarray) -> np.ndarray:
        return np.clip(self.design(features) @ self.weights, -LIMIT, LIMIT)

    def sums(self, features: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Gradient, then the upper half of the curvature of a lower bound, of the weighted likelihood."""
        x = self.design(features)
        z = x @ self.weights
        far = np.maximum(np.abs(z), 1e-6)
        curve = (x * (weight * np.tanh(far / 2) / (2 * far))[:, None]).T @ x
        p = _squash(np.clip(z, -2 * LIMIT, 2 * LIMIT))
        return np.concatenate([x.T @ (weight * (labels - p)), curve[np.triu_indices(len(curve))]])

    def moved(self, sums: np.ndarray) -> Line:
        """After one step to the top of the bound, which never lowers the likelihood."""
        size = len(self.weights)
        penalty = np.full(size, RIDGE)
        penalty[0] = 1e-6
        curve = np.zeros((size, size))
        curve[np.triu_indices(size)] = sums[size:]
        curve += np.triu(curve, 1).T
        step = np.linalg.solve(curve + np.diag(penalty), sums[:size] - penalty * self.weights)
        return self._replace(weights=self.weights + step)


def fitted(features: np.ndarray, labels: np.ndarray) -> Line:
    spread = features.std(axis=0)
    scale = np.where(spread < 1e-6, 1.0, spread)
    line = Line(features.mean(axis=0), scale, np.zeros(features.shape[1] + 1))
    for _ in range(FIRST):
        line = line.moved(line.sums(features, labels, np.ones(len(labels))))
    return line


class Handing(NamedTuple):
    """What one view tells: bins up to ``low`` are of class 0, from ``high`` on of class 1, and their weights."""

    low: int
    high: int
    weights: tuple[float, float]


def _bins(line: Line, features: np.ndarray) -> np.ndarray:
    return np.floor((line.odds(features) + LIMIT) * FINE).astype(int)


def tally(lines: list[Line], views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Documents in each bin: the first view's bins, then the second's."""
    size = 2 * LIMIT * FINE + 1
    return np.concatenate([np.bincount(_bins(k, v), minlength=size) for k, v in zip(lines, views)]).astype(float)


def told(givers: list[Line], handed: list[Handing], lines: list[Line], views) -> np.ndarray:
    """``Line.sums`` of both views over the documents that the other one hands over."""
    found = []
    for taker in (0, 1):
        limits = handed[1 - taker]
        bins = _bins(givers[1 - taker], views[1 - taker])
        chosen = (bins <= limits.low) | (bins >= limits.high)
        labels = (bins[chosen] >= limits.high).astype(float)
        weight = np.where(labels > 0, limits.weights[1], limits.weights[0])
        found.append(lines[taker].sums(views[taker][chosen], labels, weight))
    return np.concatenate(found)


def handing(counts: np.ndarray, part: float, share: float, labelled: int) -> Handing:
    """The surest ``part`` of the documents with these scores, of both classes in the share of the labels."""
    edge, prior, wanted = log(SURE / (1 - SURE)), log(share / (1 - share)), part * counts.sum()
    sure = ceil((LIMIT + prior + edge) * FINE), int((LIMIT + prior - edge) * FINE) - 1
    above, below = np.cumsum(counts[::-1])[::-1], np.cumsum(counts)
    # the fewest bins that hold enough, but none that is not sure
    high = max(sure[0], int(np.flatnonzero(above >= share * wanted)[-1]) if wanted else len(counts))
    low = min(sure[1], int(np.flatnonzero(below >= (1 - share) * wanted)[0]) if wanted else -1)
    held = below[low] if low >= 0 else 0.0, above[high] if high < len(counts) else 0.0
    most = (1 - share) * labelled, share * labelled
    return Handing(low, high, tuple(float(min(1.0, m / h)) if h else 0.0 for m, h in zip(most, held)))


class CoTrained:
    """Two views that have taught each other, and the combination of their scores.

    over: adds up ``tally`` or ``told``, given all but their last argument, over the unlabelled documents.
    """

    def __init__(self, text, meta, labels, aside, over: Callable[..., np.ndarray]):
        views = text, meta
        learn = ~aside if (~aside).any() and len(set(labels[~aside])) == 2 else np.ones(len(labels), bool)
        check = aside if len(set(labels[aside])) == 2 else learn
        share, one = labels[learn].mean(), np.ones(learn.sum())
        self.lines = [fitted(v[learn], labels[learn]) for v in views]
        for number in range(1, ROUNDS + 1):
            givers = list(self.lines)
            counts = over(tally, givers).reshape(2, -1)
            handed = [handing(c, HANDED * number, share, len(one)) for c in counts]
            for _ in range(STEPS):
                more = over(told, givers, handed, self.lines)
                own = [k.sums(v[learn], labels[learn], one) for k, v in zip(self.lines, views)]
                parts = more[: len(own[0])], more[len(own[0]) :]
                self.lines = [k.moved(a + b) for k, a, b in zip(self.lines, own, parts)]
        self.calibrated = [Logistic(k.odds(v[check])[:, None], labels[check]) for k, v in zip(self.lines, views)]
        self.combined = Logistic(self._both([v[check] for v in views]), labels[check])

    def views(self, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        return [c(k.odds(v)[:, None]) for c, k, v in zip(self.calibrated, self.lines, (text, meta))]

    def _both(self, views) -> np.ndarray:
        p = np.clip(np.column_stack(self.views(*views)), 1e-6, 1 - 1e-6)
        return np.log(p / (1 - p))

    def __call__(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return self.combined(self._both((text, meta)))


def _matrix(column) -> np.ndarray:
    rows = len(column)
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy()
    return flat.reshape(rows, -1).astype(float) if rows else np.empty((0, 0))


def _over(loose: DataFrame, widths: tuple[int, int]) -> Callable[..., np.ndarray]:
    """Adds up a function of the views over the rows of loose: one vector for each task, summed in Spark."""

    def over(function, *args) -> np.ndarray:
        size = len(function(*args, tuple(np.empty((0, w)) for w in widths)))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for part in slices(batches, 4096):
                total += function(*args, (_matrix(part.column("by_text")), _matrix(part.column("by_meta"))))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype("i4")), pa.array(total[some])], ["place", "value"])

        found = loose.select("by_text", "by_meta").mapInArrow(add, "place int, value double")
        rows = found.groupBy("place").agg(F.sum("value").alias("value")).toArrow()  # at most size rows
        total = np.zeros(size)
        total[rows.column("place").to_numpy()] = rows.column("value").to_numpy()
        return total

    return over


def _places(rows: DataFrame, column: str, own: int, shared: int) -> Places:
    """Places for the most frequent values; ties go to the value that sorts first."""
    counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), column).limit(own).collect()
    return Places({r[column]: i for i, r in enumerate(top)}, shared)


def _apply(model: CoTrained):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            text, meta = _matrix(part.column("by_text")), _matrix(part.column("by_meta"))
            scores = [*model.views(text, meta), model(text, meta)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *map(pa.array, scores)], ["doc_id", "text_score", "meta_score", "score"]
            )

    return apply


def score(docs: DataFrame, labels: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """(doc_id, held_out, text_score, meta_score, score, predicted) for every row of docs.

    docs: (doc_id, text, lang, source, n_chars); labels: (doc_id, quality).
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )
    places = _places(rows, "source", *SOURCES), _places(rows, "lang", *LANGS)
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.filter(F.col("quality").isNotNull() & ~held_out())
    marked = bounded(marked.groupBy("doc_id").agg(F.min("quality").alias("quality")), LABELS)
    figures = stored(
        rows.join(F.broadcast(marked), "doc_id", "left")  # at most about LABELS rows
        .select(*rows.columns, "quality")
        .mapInArrow(_figures(places), "doc_id long, quality int, by_text array<float>, by_meta array<float>")
    )
    known = (
        figures.filter("quality IS NOT NULL").select("by_text", "by_meta", "quality", (fold() == 3).alias("aside")).toArrow()
    )
    loose = figures.filter(F.col("quality").isNull() & ~held_out())
    quality = known.column("quality").to_numpy() > 0
    if len(set(quality)) < 2:
        constant = float((quality.sum() + 0.5) / (len(quality) + 1))
        scored = figures.select("doc_id", *(F.lit(constant).alias(n) for n in ("text_score", "meta_score", "score")))
    else:
        text, meta = _matrix(known.column("by_text")), _matrix(known.column("by_meta"))
        aside = known.column("aside").to_numpy(zero_copy_only=False).astype(bool)
        model = CoTrained(text, meta, quality.astype(float), aside, _over(loose, (text.shape[1], meta.shape[1])))
        scored = figures.select("doc_id", "by_text", "by_meta").mapInArrow(
            _apply(model), "doc_id long, text_score double, meta_score double, score double"
        )
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "text_score",
        "meta_score",
        "score",
        (F.col("score") >= cutoff).cast("int").alias("predicted"),
    )
