"""Language identification by interpolated Kneser-Ney character models.

One model of order 4 for each language seen in training. The highest order uses
counts of 4-grams, lower orders continuation counts (of how many different
characters precede); each order is discounted by n1 / (n1 + 2 n2) and
interpolated with the next lower one, the lowest with the uniform distribution.
All counts come from one distributed pass over every training text.

Grams are hashed to ``HASH_BITS`` bits and each table of a model is a sorted
array of hashes beside an array of counts, looked up by binary search. A model
so has a fixed largest size whatever the text.

The language with the lowest cross-entropy per character wins. A logistic
calibration maps the margin to the runner-up, the length and the entropy itself
to the probability that the choice is right (``score``). It is fitted on all
training documents, each judged by a model that has not counted it: there is one
for each of ``FOLDS`` parts, from the counts of all other parts. Predictions come
from the model of all training documents. ``rejected`` marks choices below
``REJECT`` or with an entropy beyond what ``TAIL`` of the right choices have, up
to a grid of ``GRID`` steps a bit; the predicted language stays in the row.

Null texts and texts without a letter are ``und`` with score 0, as is
everything if there is nothing to learn from. Held-out rows (crc32 of the id
mod 4 is 2) and null languages are never learned from. Ties go to the language
that sorts first. Repeated rows each get a row; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_lake.llm.calibration import Logistic
from listing_lake.llm.common import held_out, slices
from listing_lake.session import stored

ORDER = 4
HASH_BITS = 20
#: Characters handled in one numpy step; distinct grams a worker holds before it hands them on.
STEP, HELD = 1 << 21, 1 << 21
FOLDS = 2
GRID = 1024
REJECT = 0.5
TAIL = 0.999
UNKNOWN = "und"

_PAD = 2  # a control character in front of each text
_MASK = np.uint64((1 << HASH_BITS) - 1)
FIGURES = ("margin", "entropy", "log_length")


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """16-bit codes of all texts, each behind ORDER - 1 pads, and the texts' lengths."""
    pad = chr(_PAD) * (ORDER - 1)
    codes = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le"), "<u4")
    folded = ((codes >> 16) * 0x9E5 ^ codes) & 0xFFFF  # beyond the first plane: mixed in
    return folded.astype(np.uint64), np.fromiter(map(len, texts), np.int64, len(texts))


def _grams(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ORDER characters that end at each character of each text, packed into 64 bits."""
    packed = np.zeros(max(0, len(codes) - ORDER + 1), np.uint64)
    for i in range(ORDER):
        packed = packed << np.uint64(16) | codes[i : i + len(packed)]
    starts = np.cumsum(lengths + ORDER - 1) - lengths - ORDER + 1
    inside = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return packed[inside]


def _steps(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and texts, cut so that one step has few characters; rows may recur."""
    rows, held, size = [], [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(1, len(text)), STEP):
            piece = text[start : start + STEP]
            if size + len(piece) > STEP and held:
                yield rows, held
                rows, held, size = [], [], 0
            rows.append(row)
            held.append(piece)
            size += len(piece)
    if held:
        yield rows, held


def _unique(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, fold), parts in kept.items():
            keys, counts = _unique(*(np.concatenate(c) for c in zip(*parts)))
            names = pa.array([lang]).dictionary_encode().take(pa.array(np.zeros(len(keys), np.int32)))
            folds = pa.array(np.full(len(keys), fold, np.int32))
            yield pa.RecordBatch.from_arrays(
                [names.cast(pa.string()), folds, pa.array(keys.view(np.int64)), pa.array(counts)],
                ["lang", "fold", "gram", "n"],
            )
        kept.clear()

    for part in slices(batches, 2048):
        groups = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist()))
        texts = [t.lower() for t in part.column(0).to_pylist()]
        for group in set(groups):
            for _, step in _steps([t for t, g in zip(texts, groups) if g == group]):
                grams = _grams(*_codes(step))
                if len(grams):
                    keys, counts = np.unique(grams, return_counts=True)
                    kept.setdefault(group, []).append((keys, counts.astype(np.int64)))
                    held += len(keys)
        if held > HELD:
            kept = {k: [_unique(*(np.concatenate(c) for c in zip(*v)))] for k, v in kept.items()}
            held = sum(len(v[0][0]) for v in kept.values())
            if held > HELD // 2:
                yield from out()
                held = 0
    yield from out()


# ---------------------------------------------------------------- the model


class Table(NamedTuple):
    """Sorted hashes and, for each, a count."""

    hashes: np.ndarray
    counts: np.ndarray

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.counts[at], 0.0)


class Level(NamedTuple):
    """One order: counts of grams, and the sum and number of grams by context."""

    grams: Table
    sums: Table
    types: Table
    discount: float


def _hash(keys: np.ndarray) -> np.ndarray:
    """The low bits of Spark's xxhash64 of a long, seed 42."""
    p1, p2, p3 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    p4, p5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)

    def turn(x: np.ndarray, n: int) -> np.ndarray:
        return x << np.uint64(n) | x >> np.uint64(64 - n)

    with np.errstate(over="ignore"):
        h = (np.uint64(42) + p5 + np.uint64(8)) ^ turn(keys * p2, 31) * p1
        h = turn(h, 27) * p1 + p4
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        return (h ^ h >> np.uint64(32)) & _MASK


class Model(NamedTuple):
    """The levels of each language, lowest order first."""

    langs: tuple[str, ...]
    levels: tuple[tuple[Level, ...], ...]
    alphabet: int

    def surprise(self, grams: np.ndarray) -> np.ndarray:
        """-log2 P(last character | those before): one row for each language."""
        hashes, found = [], []
        for order in range(1, ORDER + 1):
            own = grams & np.uint64((1 << 16 * order) - 1)
            hashes.append((_hash(own), _hash(own >> np.uint64(16))))
        for levels in self.levels:
            p = np.full(len(grams), 1.0 / self.alphabet)
            for level, (own, context) in zip(levels, hashes):
                total = level.sums(context)
                safe = np.maximum(total, 1.0)
                p = np.where(
                    total > 0,
                    np.maximum(level.grams(own) - level.discount, 0) / safe
                    + level.discount * level.types(context) / safe * p,
                    p,
                )
            found.append(-np.log2(p))
        return np.array(found).reshape(len(self.langs), len(grams))


def counted(rows: DataFrame) -> DataFrame:
    """(lang, fold, gram, n) of rows (text, lang, fold), no nulls: one pass over the texts."""
    return stored(
        rows.select("text", "lang", F.col("fold").cast("int"))
        .mapInArrow(_count, "lang string, fold int, gram long, n long")
        .groupBy("lang", "fold", "gram")
        .agg(F.sum("n").alias("n"))
    )


def learn(rows: DataFrame) -> Model:
    """The model of rows (text, lang), no nulls."""
    return model_of(counted(rows.withColumn("fold", F.lit(0))))


def model_of(counts: DataFrame) -> Model:
    """The model of the counts of some folds."""
    grams = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    parts = None
    level = grams
    for order in range(ORDER, 0, -1):
        keyed = level.select("lang", "n", F.col("gram").alias("own"), F.shiftrightunsigned("gram", 16).alias("context"))
        for kind, key, value in (("grams", "own", F.sum("n")), ("sums", "context", F.sum("n")), ("types", "context", F.count("*"))):
            slot = F.xxhash64(key).bitwiseAND((1 << HASH_BITS) - 1)
            found = keyed.groupBy("lang", slot.cast("int").alias("hash")).agg(value.alias("n"))
            found = found.select("lang", F.lit(order).alias("level"), F.lit(kind).alias("kind"), "hash", "n")
            parts = found if parts is None else parts.union(found)
        shorter = F.col("gram").bitwiseAND((1 << 16 * (order - 1)) - 1) if order > 1 else F.lit(0)
        level = level.groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n"))
    # at most 3 tables of 2 ** HASH_BITS rows for each language and order
    got = parts.toArrow().combine_chunks()
    lang = got.column("lang").to_numpy(zero_copy_only=False)
    order, kind = got.column("level").to_numpy(), got.column("kind").to_numpy(zero_copy_only=False)
    hashes, counts = got.column("hash").to_numpy().astype(np.uint64), got.column("n").to_numpy().astype(float)
    langs, models = tuple(sorted(set(lang))), []

    def tables(mask: np.ndarray) -> Level:
        made = {}
        for name in ("grams", "sums", "types"):
            own = mask & (kind == name)
            by = np.argsort(hashes[own])
            made[name] = Table(hashes[own][by], counts[own][by])
        once, twice = ((made["grams"].counts == k).sum() for k in (1, 2))
        return Level(**made, discount=float(once / (once + 2 * twice)) if once and twice else 0.75)

    for name in langs:
        models.append(tuple(tables((lang == name) & (order == k)) for k in range(1, ORDER + 1)))
    characters = {h for levels in models for h in levels[0].grams.hashes.tolist()}
    return Model(langs, tuple(models), len(characters) + 1)


# ---------------------------------------------------------------- prediction


def entropies(texts: list[str], model: Model) -> np.ndarray:
    """Bits per character: a row for each text, a column for each language."""
    sums = np.zeros((len(texts), len(model.langs)))
    for rows, step in _steps(texts):
        codes, lengths = _codes(step)
        grams = _grams(codes, lengths)
        if not len(grams):
            continue
        distinct, place = np.unique(grams, return_inverse=True)
        surprise = model.surprise(distinct)
        some = np.flatnonzero(lengths)
        starts = (np.cumsum(lengths) - lengths)[some]
        for lang, bits in enumerate(surprise):
            np.add.at(sums[:, lang], np.array(rows)[some], np.add.reduceat(bits[place], starts))
    return sums / np.maximum(1, np.fromiter(map(len, texts), float, len(texts)))[:, None]


def _guess(model):
    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = model.value
        for part in slices(batches, 2048):
            given = part.column(0).to_pylist()
            texts = [t.lower() if t is not None and any(map(str.isalpha, t)) else "" for t in given]
            some = np.array([bool(t) for t in texts]) & bool(known.langs)
            lang = np.full(len(texts), UNKNOWN, object)
            margin, entropy = np.zeros(len(texts)), np.zeros(len(texts))
            if some.any():
                bits = entropies(texts, known)[some]
                lang[some] = np.array(known.langs, object)[bits.argmin(axis=1)]
                ranked = np.sort(bits, axis=1)
                entropy[some] = ranked[:, 0]
                margin[some] = ranked[:, 1] - ranked[:, 0] if ranked.shape[1] > 1 else 1.0
            length = np.log1p(np.fromiter(map(len, texts), float, len(texts)))
            kept = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in kept]
                + [pa.array(lang, pa.string()), pa.array(margin), pa.array(entropy), pa.array(length)],
                [*kept, "lang_pred", *FIGURES],
            )

    return guess


def _features(columns: dict[str, np.ndarray]) -> np.ndarray:
    evidence = np.sqrt(columns["margin"] * np.expm1(columns["log_length"]).clip(0))
    return np.column_stack([evidence, columns["margin"], columns["entropy"], columns["log_length"]])


def _feature_columns() -> list[Column]:
    """The same as columns."""
    evidence = F.sqrt(F.col("margin") * F.greatest(F.expm1("log_length"), F.lit(0.0)))
    return [evidence, F.col("margin"), F.col("entropy"), F.col("log_length")]


def _apply(model: Logistic, limit: float):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            columns = {n: part.column(n).to_numpy() for n in FIGURES}
            found = part.column("lang_pred").to_numpy(zero_copy_only=False) != UNKNOWN
            score = np.where(found, model(_features(columns)), 0.0)
            rejected = (score < REJECT) | (columns["entropy"] > limit)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in ("doc_id", "held_out", "lang_pred")), pa.array(score), pa.array(rejected)],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return apply


def _guessed(rows: DataFrame, model: Model) -> DataFrame:
    """What the model says of rows (text, doc_id, held_out, lang)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, held_out boolean, lang string, lang_pred string, "
    return rows.select("text", "doc_id", "held_out", "lang").mapInArrow(
        _guess(shared), schema + ", ".join(f"{n} double" for n in FIGURES)
    )


def _entropy_limit(right: DataFrame) -> float:
    """The end of the grid cell up to which ``TAIL`` of the entropies lie; there are few cells."""
    cells = right.groupBy(F.floor(F.col("entropy") * GRID).alias("cell")).agg(F.count("*").alias("n")).orderBy("cell").collect()
    below = np.cumsum([r.n for r in cells])
    return (cells[int(np.searchsorted(below, TAIL * below[-1]))].cell + 1) / GRID if cells else np.inf


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row of docs (doc_id, text, lang)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        held_out().alias("held_out"),
        F.when(~held_out(), F.col("lang").cast("string")).alias("lang"),
        (F.shiftright(F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)), 2) % FOLDS).cast("int").alias("fold"),
    )
    training = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    counts, judged = counted(training), None
    for fold in range(FOLDS):
        others = model_of(counts.filter(F.col("fold") != fold))
        found = stored(_guessed(training.filter(F.col("fold") == fold), others).select("lang", "lang_pred", *FIGURES))
        judged = found if judged is None else judged.union(found)
    judged = judged.filter(F.col("lang_pred") != UNKNOWN)
    right = F.col("lang") == F.col("lang_pred")
    calibration = Logistic.of_table(judged, _feature_columns(), right)
    limit = _entropy_limit(judged.filter(right))
    return _guessed(rows, model_of(counts)).select("doc_id", "held_out", "lang_pred", *FIGURES).mapInArrow(
        _apply(calibration, limit),
        "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean",
    )
