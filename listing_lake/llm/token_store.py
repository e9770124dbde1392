"""Token ids as binary files, with Elias-Fano coded document boundaries.

Documents are dealt out and sorted by id; each task encodes its own range in order
and cuts it into shards of about ``SHARD`` ids. A shard is one file:

=========  ==============================================================
header     ``_HEAD``: magic, bytes of an id, documents, null ids among them
documents  Elias-Fano code of doc_id less the first one
ends       Elias-Fano code of where documents end in the id array
ids        the array, little-endian, 2 bytes an id if the vocabulary allows
=========  ==============================================================

Elias-Fano splits each value of an ascending sequence into low bits, stored as
they are, and a high part, stored as a one bit at (high part + place). That takes
about 2 + log2(largest / count) bits a value. ``select`` finds the n-th one bit
from the position of every ``SAMPLE``-th, kept in 32 bits, so a document's offsets
are found without a table of 64-bit numbers.

The folder of a shard states its ``part`` (the task, in order of ids), the ids of
the part ``before`` it, and how many ``ids`` it has: the start of each document in
the whole is known from a listing. The files are written by Spark's text writer,
which passes the bytes on as they are and adds one line end, so any store that
Spark can write to will do, and only committed tasks leave files.

Texts of Latin letters, digits and ASCII signs are lower-cased and cut into words
here (such a text needs no more), and the tokenizer library's model encodes every
distinct word. Other texts are cut at ASCII white space, which no token crosses, and
the library encodes every piece that is not plain; strings of special tokens become
those tokens, as the library has it.

Null text: empty, that is the end id alone. Null ids come first. Rows that share
an id stay separate, in the order of their texts' hashes; equal rows too, and no
id or text has to fit one task. Other columns are ignored. Empty tables: no files
and no rows.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from listing_lake.llm.common import slices

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END = 1
#: Ids of a shard, but for its last document.
SHARD = 1 << 23
#: One bits between two known positions.
SAMPLE = 4096
#: Words and other pieces of text whose ids a worker remembers in one generation.
REMEMBERED = 400_000
#: Characters of a text that are cut into words at a time.
CHUNK = 1 << 20

_MAGIC = b"IDSHARD1"
_HEAD = struct.Struct("<8sIII")
_FANO = struct.Struct("<qIBI")  # first value, count, low bits, bytes of high bits
# What the library does with a text before its model. For these characters that comes
# to the words below: they are composed already, and lower-cased one by one.
_STEPS = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "split": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
_PLAIN, _NOTHING = re.compile(r"[\t\n\r -~À-ÖØ-öø-įı-ſ]*"), re.compile("")
_SPACE = re.compile("[\t-\r ]+")
_WORDS = re.compile(r"[a-zß-öø-ſ]+|'(?:[stmd]|re|ve|ll)|[0-9]|[!-/:-@\[-`{-~]+")
_COUNTS = ("part", "before", "ids")


# ---------------------------------------------------------------- Elias-Fano


class EliasFano:
    """An ascending sequence of integers of 64 bits."""

    def __init__(self, first: int, count: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.first, self.count, self.width = first, count, width
        self.low, self.high, self.samples = low, high, samples
        self.padded = np.concatenate([low, np.zeros(9, np.uint8)])  # any value may be read as nine bytes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        count = len(values)
        first = int(values[0]) if count else 0
        rest = values.astype(np.int64).view(np.uint64) - np.uint64(first % 2**64)  # modulo 2 ** 64, so right for any range
        largest = int(rest[-1]) if count else 0
        width = max(0, (largest // max(1, count)).bit_length() - 1)
        bits = (rest[:, None] >> np.arange(width, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        ones = (rest >> np.uint64(width)).astype(np.int64) + np.arange(count)
        high = np.zeros((int(ones[-1]) >> 3) + 1 if count else 0, np.uint8)
        np.bitwise_or.at(high, ones >> 3, np.uint8(1) << (ones & 7).astype(np.uint8))
        return cls(first, count, width, low, high, ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = _FANO.pack(self.first, self.count, self.width, len(self.high))
        return b"".join((head, self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()))

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        """The sequence that begins at a position, and the position behind it."""
        first, count, width, size = _FANO.unpack_from(data, at)
        at += _FANO.size
        arrays = []
        for kind, n in (("u1", -(-count * width // 8)), ("u1", size), ("<u4", -(-count // SAMPLE))):
            arrays.append(np.frombuffer(data, kind, n, at))
            at += arrays[-1].nbytes
        return cls(first, count, width, *arrays), at

    def select(self, places: np.ndarray) -> np.ndarray:
        """Where the one bits number ``places`` are."""
        found, blocks = np.empty(len(places), np.int64), places // SAMPLE
        for block in np.unique(blocks):
            start = int(self.samples[block])
            end = int(self.samples[block + 1]) if block + 1 < len(self.samples) else 8 * len(self.high)
            bits = np.unpackbits(self.high[start >> 3 : (end >> 3) + 1], bitorder="little")
            ones = np.flatnonzero(bits[start & 7 :]) + start
            mine = blocks == block
            found[mine] = ones[places[mine] % SAMPLE]
        return found

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        places = np.asarray(places, np.int64)
        values = (self.select(places) - places).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            bit = places * self.width
            byte, shift = bit >> 3, (bit & 7).astype(np.uint64)
            octets = self.padded[byte[:, None] + np.arange(8)]
            word = np.ascontiguousarray(octets).view("<u8")[:, 0] >> shift
            # a value of more than 57 bits may end in a ninth byte
            last = self.padded[byte + 8].astype(np.uint64) << (np.uint64(63) - shift) << np.uint64(1)
            values |= (word | last) & np.uint64(2**self.width - 1)
        return (values + np.uint64(self.first % 2**64)).view(np.int64)


# ---------------------------------------------------------------- tokens


def _steps(path: str) -> dict:
    """The steps of a tokenizer file in the form of _STEPS, as far as it has them."""
    file = json.loads(Path(path).read_text())
    split = ((file["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
    return {"normalizer": [n["type"] for n in (file["normalizer"] or {}).get("normalizers", [])], "split": split}


class _Recent(dict):
    """What ``find`` says, remembered for the last keys: two generations of a bounded size."""

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.find(key)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class _Words(_Recent):
    """Word as the tokenizer's normalizer leaves it -> its ids as little-endian bytes."""

    def __init__(self, tokenizer: Tokenizer, kind: str):
        super().__init__()
        self.model, self.kind = tokenizer.model, kind
        self.letters = ByteLevel(add_prefix_space=False, use_regex=False)

    def find(self, word: str) -> bytes:
        shown = word if word.isascii() else self.letters.pre_tokenize_str(word)[0][0]
        return np.array([t.id for t in self.model.tokenize(shown)], self.kind).tobytes()


class _Ids(_Recent):
    """Piece of text that is not plain -> its ids as little-endian bytes."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.words = _Words(self.tokenizer, self.kind)
        self.plain = _PLAIN if _STEPS.items() <= _steps(path).items() else _NOTHING

    def find(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, self.kind).tobytes()

    def of(self, text: str) -> bytes | None:
        """The ids of a plain text, None if it is not one."""
        if self.plain.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.words.__getitem__, _WORDS.findall(text.lower())))
        return None


@cache
def _ids(path: str) -> _Ids:
    return _Ids(path)


def _chunks(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > CHUNK:
        cut = _SPACE.search(text, start + CHUNK)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str | None, ids: _Ids, end: int = END) -> bytes:
    """The ids of one text and the end id, in bytes."""
    parts = []
    for chunk in _chunks(text or ""):
        found = ids.of(chunk)
        if found is not None:
            parts.append(found)
            continue
        for piece in _SPACE.split(chunk):
            found = ids.of(piece)
            parts.append(ids[piece] if found is None else found)
    return b"".join((*parts, np.array([end], ids.kind).tobytes()))


# ---------------------------------------------------------------- shards


def pack(doc_ids: list[int | None], texts: list[bytes], width: int) -> bytes:
    """One shard of documents in ascending order, nulls first."""
    nulls = doc_ids.count(None)
    known = EliasFano.of(np.array(doc_ids[nulls:], np.int64))
    ends = EliasFano.of(np.cumsum([len(t) // width for t in texts]))
    head = _HEAD.pack(_MAGIC, width, len(doc_ids), nulls)
    return b"".join((head, known.to_bytes(), ends.to_bytes(), *texts))


class Shard:
    """One file, opened."""

    def __init__(self, data: bytes | memoryview):
        magic, self.width, self.count, self.nulls = _HEAD.unpack_from(data, 0)
        if magic != _MAGIC:
            raise ValueError("not a shard of token ids")
        self.known, at = EliasFano.read(data, _HEAD.size)
        self.ends, at = EliasFano.read(data, at)
        self.ids = np.frombuffer(data, f"<u{self.width}", self.total, at)

    @property
    def total(self) -> int:
        return int(self.ends[np.array([self.count - 1])][0]) if self.count else 0

    def doc_ids(self, places: np.ndarray) -> list[int | None]:
        values = self.known[places[places >= self.nulls] - self.nulls].tolist()
        return [None] * int((places < self.nulls).sum()) + values

    def bounds(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where documents begin and end in the shard."""
        starts = np.zeros(len(places), np.int64)
        starts[places > 0] = self.ends[places[places > 0] - 1]
        return starts, self.ends[places]


def _shards(path: str, end: int, shard: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, part = _ids(path), TaskContext.get().partitionId()
        width = int(ids.kind[-1])
        doc_ids, texts, size, before = [], [], 0, 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([size], pa.int64()),
                    pa.array([pack(doc_ids, texts, width)], pa.binary()),
                ],
                ["part", "before", "ids", "content"],
            )

        for rows in slices(batches):
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                encoded = encode(text, ids, end)
                doc_ids.append(doc_id)
                texts.append(encoded)
                size += len(encoded) // width
                if size >= shard:
                    yield full()
                    before, doc_ids, texts, size = before + size, [], [], 0
        if doc_ids:
            yield full()

    return build


def write(docs: DataFrame, folder: str, path: str = TOKENIZER, end: int = END, shard: int = SHARD) -> None:
    """Encodes docs (doc_id, text) into shards below a new folder."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("version"),
        F.monotonically_increasing_id().alias("nth"),  # deals out rows that are equal
    )
    order = ["doc_id", "version", "nth"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    (
        ordered.select("doc_id", "text")
        .mapInArrow(_shards(path, end, shard), "part int, before long, ids long, content binary")
        .withColumn("content", F.col("content").cast("string"))  # the same bytes
        .write.partitionBy(*_COUNTS)
        .text(folder)
    )


def _files(spark: SparkSession, folder: str) -> DataFrame | None:
    """(content, part, before, ids) of each file, None without files."""
    found = spark.read.format("binaryFile").load(folder)
    if "part" not in found.columns:
        return None
    return found.select("content", *(F.col(c).cast("long").alias(c) for c in _COUNTS))


def _documents(bases: dict[int, int], keep_ids: bool):
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in slices(batches, 1):
            base = bases[files.column("part")[0].as_py()] + files.column("before")[0].as_py()
            shard = Shard(memoryview(files.column("content")[0].as_buffer()))
            for first in range(0, shard.count, SAMPLE):
                places = np.arange(first, min(shard.count, first + SAMPLE))
                starts, ends = shard.bounds(places)
                own = [shard.ids[a:b].astype("<u4") for a, b in zip(starts, ends)]
                columns = {
                    "doc_id": pa.array(shard.doc_ids(places), pa.int64()),
                    "start": pa.array(base + starts),
                    "n_tokens": pa.array(ends - starts),
                    "ids_crc32": pa.array([zlib.crc32(ids) for ids in own], pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array([ids.view("i4") for ids in own], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return documents


def read(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; keep_ids adds the ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids
    files = _files(spark, folder)
    if files is None:
        return spark.createDataFrame([], schema)
    # from the names of the folders; one row for each task that wrote
    sizes = files.groupBy("part").agg(F.sum("ids").alias("ids")).collect()
    bases, total = {}, 0
    for part, ids in sorted(map(tuple, sizes)):
        bases[part], total = total, total + ids
    return files.select("content", "part", "before").mapInArrow(_documents(bases, keep_ids), schema)
