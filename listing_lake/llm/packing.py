"""Best-fit packing by exact-complement hashing.

Documents become token ids and end with id 0; only longer ones than a sequence
are cut. How pieces are combined depends on their lengths alone, and there are
at most as many lengths as a sequence has tokens. So the plan is made on the
counts of lengths: for each length, longest first, an index of single, pair and
triple sums finds lengths that fill the gap exactly, and the combination is used
as often as its lengths are available. What no exact combination takes is packed
best-fit: the largest piece that still fits, again for as many sequences at once
as the counts allow.

Each piece then finds its place from its rank among the pieces of its length.
Ranks are counted within partitions while texts are tokenised; the partitions'
counts are added up by a window over (length, partition) rows. Pieces are
written before they are ranked, so a lost executor cannot renumber them.

Null text: empty, that is the single id 0. Empty tables give no rows. Repeated
rows are packed like any others. The ids are those that the ``tokenizers`` library
gives for the same file by default: texts are split at the strings of its special
tokens first, which become those tokens.
"""

from __future__ import annotations

import array
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listing_lake.llm.common import slices
from listing_lake.session import stored

SEQUENCE = 2048
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Code points of a text that are split into words at a time.
CHUNK = 1 << 20
#: Words whose ids a worker remembers at most; beyond that it starts anew.
REMEMBERED = 1_000_000

# The word pattern of the tokenizer. For texts of these letters only, the standard
# library's character classes are the same as the pattern's and faster.
_WORDS = regex.compile(public_tokenizers.PATTERN)
_PLAIN = re.compile(r"[\t\n\r -~À-ɏ]*")
_PLAIN_WORDS = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_CUT = re.compile(r"(?<=\S) (?=\S)")  # a word always begins here
_END = array.array("I", [0]).tobytes()


def _encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file, by a library that encodes single words faster.

    That library merges by rank; here a token's rank is its id, which holds if the
    file lists its merges in the order of their ids.
    """
    model = json.loads(Path(path).read_text())["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ids = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if ids != sorted(ids):
        raise ValueError(f"the merges of {path} are not in the order of their ids")
    special = {t["content"] for t in json.loads(Path(path).read_text())["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Ids(dict):
    """Word -> its ids as little-endian unsigned 32-bit bytes, remembered up to a bound."""

    def __init__(self, path: str):
        super().__init__()
        self.encode = _encoding(path).encode_ordinary
        added = json.loads(Path(path).read_text())["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError(f"special tokens of {path} take more than their own string")
        self.special = {t["content"]: array.array("I", [t["id"]]).tobytes() for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")" if added else "(?!)")

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = array.array("I", self.encode(word)).tobytes()
        return found


_ids = cache(_Ids)


def _words(text: str) -> list[str]:
    return (_PLAIN_WORDS if _PLAIN.fullmatch(text) else _WORDS).findall(text)


def _chunks(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > CHUNK:
        cut = _CUT.search(text, start + CHUNK)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(texts: list[str | None], path: str = TOKENIZER) -> Iterator[bytes]:
    """The ids of each text and the closing id 0, as bytes."""
    ids = _ids(path)
    for text in texts:
        parts = []
        for said in ids.at_special.split(text or ""):
            if said in ids.special:
                parts.append(ids.special[said])
                continue
            for chunk in _chunks(said):
                parts.append(b"".join(map(ids.__getitem__, _words(chunk))))
        parts.append(_END)
        yield b"".join(parts)


def _pieces(path: str, size: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_id, seen = TaskContext.get().partitionId(), defaultdict(int)
        for part in slices(batches):
            out = []
            for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist(), path)):
                total = len(ids) // 4
                ends = range(total % size or size, total + 1, size) if total > size else (total,)
                start = 0
                for piece, end in enumerate(ends):
                    own = ids[4 * start : 4 * end]
                    row = (doc_id, piece, start, end - start, zlib.crc32(own), part_id, seen[end - start])
                    out.append((*row, np.frombuffer(own, "<u4").astype("i4")) if keep_ids else row)
                    seen[end - start] += 1
                    start = end
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], _NAMES[: len(out[0])]
                )

    return cut


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


# ---------------------------------------------------------------- the plan


class _Index:
    """Which lengths are left, and which sums two of them make."""

    def __init__(self, counts: dict[int, int], size: int):
        self.left = np.zeros(size + 1, np.int64)
        for length, count in counts.items():
            self.left[length] = count
        there = np.flatnonzero(self.left)
        # pair sums of the start; a sum that has run out since is found empty when looked up
        self.pairs = np.zeros(2 * size + 1, bool)
        for length in there:
            self.pairs[there + length] = True

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.left[gap] else None

    def pair(self, gap: int) -> tuple[int, ...] | None:
        if gap < 2 or not self.pairs[gap]:
            return None
        low = np.arange(1, gap // 2 + 1)
        found = low[(self.left[low] > 0) & (self.left[gap - low] > 0)]
        return (gap - int(found[0]), int(found[0])) if len(found) else None

    def triple(self, gap: int) -> tuple[int, ...] | None:
        highs = np.flatnonzero(self.left[: gap - 1])[::-1]
        for high in highs[self.pairs[gap - highs]]:
            if rest := self.pair(gap - int(high)):
                return (int(high), *rest)
        return None

    def times(self, lengths: tuple[int, ...]) -> int:
        return min(int(self.left[x]) // lengths.count(x) for x in set(lengths))


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns and how often each is used: a pattern is ((length, copies), ...).

    Uses exactly the given counts. Every step uses up at least one length, so
    the plan is short however many pieces there are.
    """
    index, made = _Index(counts, size), []

    def use(lengths: tuple[int, ...], times: int) -> None:
        copies = tuple((x, lengths.count(x)) for x in dict.fromkeys(lengths))
        for x, n in copies:
            index.left[x] -= n * times
        made.append((copies, times))

    for longest in range(size, 0, -1):
        gap = size - longest
        while index.left[longest]:
            fills = ((),) if gap == 0 else (f(gap) for f in (index.single, index.pair, index.triple))
            for fill in fills:
                # a fill that needs the longest once more than it is there does not count
                if fill is not None and (times := index.times((longest, *fill))):
                    use((longest, *fill), times)
                    break
            else:
                break
    while len(there := np.flatnonzero(index.left)):
        lengths, gap = [(int(there[-1]), 1)], size - int(there[-1])
        for x in map(int, there[::-1]):
            free = int(index.left[x]) - (x == lengths[0][0])
            if n := min(gap // x, free):
                if x == lengths[0][0]:
                    lengths[0] = (x, 1 + n)
                else:
                    lengths.append((x, n))
                gap -= n * x
        times = min(int(index.left[x]) // n for x, n in lengths)
        for x, n in lengths:
            index.left[x] -= n * times
        made.append((tuple(lengths), times))
    return made


def _places(made) -> dict[str, np.ndarray]:
    """For each length, ranges of ranks: where they begin and what place they mean."""
    rows, used, first = [], defaultdict(int), 0
    for pattern, times in made:
        offset = 0
        for length, copies in pattern:
            rows.append((length, used[length], copies, first, offset))
            used[length] += copies * times
            offset += length * copies
        first += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "low", "copies", "first", "offset"), columns))


def _placed(places: dict[str, np.ndarray]):
    keys = (places["length"] << 44) + places["low"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 44) + rank, "right") - 1
            nth, copies = rank - places["low"][at], places["copies"][at]
            more = {
                "sequence_id": places["first"][at] + nth // copies,
                "offset": places["offset"][at] + nth % copies * length,
            }
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + [pa.array(v) for v in more.values()], kept + list(more)
            )

    return find


def pack(docs: DataFrame, size: int = SEQUENCE, path: str = TOKENIZER, keep_ids: bool = False) -> DataFrame:
    """One row for each piece of docs (doc_id, text), with its sequence and offset.

    keep_ids adds the token ids themselves.
    """
    schema = _SCHEMA + (", ids array<int>" if keep_ids else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    pieces = stored(rows.mapInArrow(_pieces(path, size, keep_ids), schema))
    tally = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    counts = tally.groupBy("length").agg(F.sum("n")).collect()  # at most ``size`` rows
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = tally.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids,
        (F.col("base") + F.col("nth")).alias("rank"),
    )
    shown = _SCHEMA.removesuffix(", part int, nth long") + (", ids array<int>" if keep_ids else "")
    return ranked.mapInArrow(
        _placed(_places(plan(dict(map(tuple, counts)), size))),
        f"{shown}, sequence_id long, offset long",
    )
