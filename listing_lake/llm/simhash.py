"""SimHash fingerprints, linked through the anchors of a covering code.

Fingerprints: 64 bits, one vote for each 3-word shingle (repeats included) by
its XXH64, after lower-casing A-Z. Two fingerprints link if at most ``THRESHOLD``
bits differ; a component is what links reach.

The anchors are the pairs of codewords of two binary Golay codes of length 23,
laid over bits 0-22 and 23-45. That code is perfect: each half lies within
distance 3 of exactly one codeword. A fingerprint is at home at its nearest
anchor. If two fingerprints differ in d1 and d2 bits of the halves, then the
second one lies within 3 + d1 and 3 + d2 of the home of the first, so it is
replicated to every anchor within those radii for d1 + d2 <= THRESHOLD and the
two meet there: no link is lost. Only distinct fingerprints take part, so exact
copies cost nothing, and a fingerprint has at most 64 + 64 * 63 / 2 links.

Null and empty texts and texts of white space only have fingerprint zero; they
link like any other. Repeated rows each get a row. An empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listing_lake.llm.common import components, slices
from listing_lake.session import stored

SHINGLE = 3
SEED = 42
THRESHOLD = 2
#: Bytes of a text that are split into words at a time.
CHUNK = 1 << 22

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)[:, ::-1].astype(np.int64)
_GOLAY, _LENGTH, _CHECKS, _RADIUS = 0b101011100011, 23, 11, 3


def _chunks(text: bytes) -> Iterator[bytes]:
    start = 0
    while len(text) - start > CHUNK:
        cut = _SPACE.search(text, start + CHUNK)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _votes(shingles: list[bytes]) -> np.ndarray:
    """How many hashes have each bit set, bit 0 first."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", len(shingles))
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if len(octets) < 400:
        return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text as an unsigned integer."""
    votes, total, carried = np.zeros(64, np.int64), 0, []
    for chunk in _chunks((text or "").encode().lower()):
        words = carried + chunk.split()
        shingles = list(map(b" ".join, zip(words, words[1:], words[2:])))
        votes += _votes(shingles)
        total += len(shingles)
        carried = words[-2:]
    if not total and carried:
        votes, total = _votes([b" ".join(carried)]), 1
    return int(np.packbits(votes * 2 > total, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = np.fromiter(map(fingerprint, part.column(1).to_pylist()), np.uint64, part.num_rows)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(2), pa.array(found.view(np.int64))], ["doc_id", "version", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, version, fp): fp holds the 64 bits as a signed long, version is a hash of the text."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, F.xxhash64(text).alias("version"))
    return rows.mapInArrow(_fingerprints, "doc_id long, version long, fp long")


# ---------------------------------------------------------------- anchors


@cache
def _syndromes_of_bits() -> np.ndarray:
    """Remainder of each single bit modulo the generator polynomial."""
    found = []
    for bit in range(_LENGTH):
        rest = 1 << bit
        for high in range(_LENGTH - 1, _CHECKS - 1, -1):
            if rest >> high & 1:
                rest ^= _GOLAY << (high - _CHECKS)
        found.append(rest)
    return np.array(found, np.int64)


def _syndrome(words: np.ndarray) -> np.ndarray:
    found = np.zeros(len(words), np.int64)
    for bit, rest in enumerate(_syndromes_of_bits()):
        found ^= (words >> bit & 1) * rest
    return found


@cache
def _rings() -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """For ring r: error patterns of weight 3 + r (ring 0: at most 3), by syndrome.

    Each ring is (starts, patterns): the patterns of syndrome s are
    patterns[starts[s] : starts[s + 1]].
    """
    rings = []
    level = np.zeros(1, np.int64)
    inner = [level]
    for weight in range(1, _RADIUS + THRESHOLD + 1):
        one = 1 << np.arange(_LENGTH, dtype=np.int64)
        grown = (level[:, None] | one)[level[:, None] < one]  # each set of bits once, lowest first
        level = np.unique(grown)
        if weight <= _RADIUS:
            inner.append(level)
        if weight >= _RADIUS:
            ring = np.concatenate(inner) if weight == _RADIUS else level
            order = np.argsort(s := _syndrome(ring), kind="stable")
            starts = np.searchsorted(s[order], np.arange((1 << _CHECKS) + 1))
            rings.append((starts, ring[order]))
    return tuple(rings)


def _near(words: np.ndarray, ring: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into words, codeword) for every codeword in that ring around each word."""
    starts, patterns = _rings()[ring]
    s = _syndrome(words)
    counts = starts[s + 1] - starts[s]
    index = np.repeat(np.arange(len(words)), counts)
    within = np.arange(len(index)) - np.repeat(np.cumsum(counts) - counts, counts)
    return index, words[index] ^ patterns[starts[s][index] + within]


def _anchors(fps: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, anchor) for every anchor whose two rings add up to at most reach."""
    mask = (1 << _LENGTH) - 1
    first, second = fps & mask, fps >> _LENGTH & mask
    indexes, anchors = [], []
    for outer in range(reach + 1):
        i, code = _near(first, outer)
        for inner in range(reach - outer + 1):
            j, other = _near(second[i], inner)
            indexes.append(i[j])
            anchors.append(code[j] | other << _LENGTH)
    return np.concatenate(indexes), np.concatenate(anchors)


def _at_anchors(reach: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2048):
            fps = part.column(0).to_numpy()
            index, anchors = _anchors(fps, reach)
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(fps[index])], ["anchor", "fp"])

    return emit


def links(fps: DataFrame) -> DataFrame:
    """(a, b), a < b: every two of the distinct fingerprints (fp) that differ in few bits.

    Spark takes the anchors for as small as the fingerprints that they are made of, so it is
    told to sort both sides: a fingerprint is sent to some sixty anchors, and a broadcast
    of those would not fit into the driver where the fingerprints themselves are under its limit.
    """
    schema = "anchor long, fp long"
    homes = fps.select("fp").mapInArrow(_at_anchors(0), schema).withColumnRenamed("fp", "a")
    probes = fps.select("fp").mapInArrow(_at_anchors(THRESHOLD), schema).withColumnRenamed("fp", "b")
    close = (
        (homes["anchor"] == probes["anchor"])
        & (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= THRESHOLD)
    )
    return homes.join(probes.hint("merge"), close).select("a", "b")


def _members(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, version, fp), and for every fp the root of its component and its smallest id."""
    rows = stored(fingerprints(docs))
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    reached = components(links(distinct))
    return rows, distinct.join(reached, distinct["fp"] == reached["node"], "left").select(
        F.col("fp").alias("own_fp"), "least", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs (doc_id, text).

    component_id is the smallest doc_id reachable over links, the row's own
    included; rows with a null id get the smallest id they link to, else null.
    """
    rows, own = _members(docs)
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    named = own.join(least, "root").select("own_fp", "component_id")
    return rows.join(named, rows["fp"] == named["own_fp"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that represent their component: the smallest id, of that the smallest text hash.

    A document is an id with a text: rows that share an id but not the text are
    judged one by one, and rows that repeat the representative in both stay. Rows
    with a null id are kept.
    """
    rows, own = _members(docs)
    rooted = stored(
        rows.filter("doc_id IS NOT NULL").join(own, rows["fp"] == own["own_fp"]).select("doc_id", "version", "root")
    )
    # written, so that Spark can split the join at the root of a large group
    kept = stored(rooted.groupBy("root").agg(F.min(F.struct("doc_id", "version")).alias("kept")))
    dropped = (
        rooted.join(kept, "root")
        .filter(F.struct("doc_id", "version") != F.col("kept"))
        .select(F.col("doc_id").alias("dropped_id"), F.col("version").alias("dropped_version"))
        .distinct()
    )
    same = (docs["doc_id"].cast("long") == dropped["dropped_id"]) & (
        F.xxhash64(docs["text"].cast("string")) == dropped["dropped_version"]
    )
    return docs.join(dropped, same, "left_anti")
