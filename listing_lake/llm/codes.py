"""Vector codes by product quantisation, with a dictionary of values for each dimension.

Each component x becomes the integer floor(``SCALE`` * x); a vector is cut into
``PARTS`` equal parts, and each part is replaced by the number of the nearest
entry of that part's codebook.

Vectors are kept in blocks of rows. A block has, for each dimension, the sorted
distinct integers that occur there (its dictionary) and the place of each row's
integer in it (its codes); that is made once and written. To assign a block, the
squared differences of every dictionary value to all entries are tabulated, and
the distance of a part is gathered from the tables of its dimensions by the codes
and added up: multiplications are spent on distinct values, not on rows. All
arithmetic is on integers, so results do not depend on how rows are dealt out.

Codebooks are the only state of a round: tasks hand on sums and counts of each
entry, added up before and after the shuffle, and the driver gets one row for each
entry of each part, whatever the input.

Rows whose vector is null or holds null or non-finite components are dropped;
labels and ids may be null and ids may repeat. The first entries are the vectors
with the smallest ids (null ids last, equal ids by vector); with fewer vectors than
``ENTRIES`` there are as many entries. Ties go to the lower entry; an entry without
parts stays. Vectors whose length ``PARTS`` does not divide are filled up with zero
components. Vectors of each length have codebooks of their own. Integers are held
within ``LIMIT`` so that sums of squares stay exact. Other columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_lake.llm.common import slices
from listing_lake.session import stored

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Rows of a block.
BLOCK = 4096
#: Largest absolute integer: squared differences of 1024 components stay below 2 ** 63.
LIMIT = 1 << 25


def integers(vector: Column, scale: int = SCALE, limit: Column | int = LIMIT) -> Column:
    """The components as integers, in doubles; null if any is null or not finite."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    most = (F.lit(limit) if isinstance(limit, int) else limit).cast("double")

    def whole(x: Column) -> Column:
        held = F.greatest(F.least(x, most), -most)  # before the product, which could overflow
        return F.greatest(F.least(F.floor(held * scale).cast("double"), most), -most)

    return F.when(fine, F.transform(parts, whole))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector, dim) of the rows that count."""
    found = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        integers(F.col("embedding")).alias("vector"),
    )
    return found.filter("vector IS NOT NULL").withColumn("dim", F.size("vector"))


# ---------------------------------------------------------------- blocks

_BLOCK = "dim int, n int, vec_ids array<long>, labels array<long>, sizes array<int>, dictionary binary, codes binary"


def _blocks(parts: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, BLOCK):
            for dim in rows.column("dim").unique().to_pylist():
                own = rows.filter(pa.compute.equal(rows.column("dim"), dim))
                width = max(1, -(-dim // parts)) * parts
                values = np.zeros((own.num_rows, width), np.int32)
                flat = own.column("vector").flatten().to_numpy(zero_copy_only=False)
                values[:, :dim] = flat.reshape(own.num_rows, dim)
                dictionaries, codes = [], np.empty((width, own.num_rows), "<u2")
                for d in range(width):
                    distinct, codes[d] = np.unique(values[:, d], return_inverse=True)
                    dictionaries.append(distinct.astype("<i4"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([dim], pa.int32()),
                        pa.array([own.num_rows], pa.int32()),
                        pa.array([own.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([own.column("label").to_pylist()], pa.list_(pa.int64())),
                        pa.array([[len(x) for x in dictionaries]], pa.list_(pa.int32())),
                        pa.array([np.concatenate(dictionaries).tobytes()], pa.binary()),
                        pa.array([codes.tobytes()], pa.binary()),
                    ],
                    ["dim", "n", "vec_ids", "labels", "sizes", "dictionary", "codes"],
                )

    return blocks


class _Block:
    """A row of the table of blocks."""

    def __init__(self, row: pa.RecordBatch):
        self.dim, self.n = row.column("dim")[0].as_py(), row.column("n")[0].as_py()
        sizes = row.column("sizes")[0].as_py()
        values = np.frombuffer(row.column("dictionary")[0].as_buffer(), "<i4").astype(np.int64)
        self.dictionaries = np.split(values, np.cumsum(sizes)[:-1])
        self.codes = np.frombuffer(row.column("codes")[0].as_buffer(), "<u2").reshape(-1, self.n)

    def assign(self, part: int, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of each row's part; book: entries x width."""
        width = book.shape[1]
        away = np.zeros((self.n, len(book)), np.int64)
        for d in range(width):
            at = part * width + d
            table = (self.dictionaries[at][:, None] - book[None, :, d]) ** 2
            away += table[self.codes[at]]
        nearest = away.argmin(axis=1)  # the first of equals
        return nearest, away[np.arange(self.n), nearest]

    def values(self, part: int, width: int) -> np.ndarray:
        return np.stack(
            [self.dictionaries[d][self.codes[d]] for d in range(part * width, (part + 1) * width)], axis=1
        )


# ---------------------------------------------------------------- rounds

_SUMS = "dim int, part int, entry int, place int, total long, n long"


def _gather(books: dict[int, np.ndarray]):
    """Sums of the parts of each entry, one row for each component."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {dim: np.zeros(book.shape, np.int64) for dim, book in books.items()}
        counts = {dim: np.zeros(book.shape[:2], np.int64) for dim, book in books.items()}
        met = set()
        for row in slices(batches, 1):
            block = _Block(row)
            met.add(block.dim)
            for part, book in enumerate(books[block.dim]):
                nearest, _ = block.assign(part, book)
                counts[block.dim][part] += np.bincount(nearest, minlength=len(book))
                np.add.at(totals[block.dim][part], nearest, block.values(part, book.shape[1]))
        for dim in sorted(met):
            part, entry, place = (x.ravel() for x in np.indices(totals[dim].shape, np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(part), dim, np.int32)),
                    pa.array(part),
                    pa.array(entry),
                    pa.array(place),
                    pa.array(totals[dim].ravel()),
                    pa.array(counts[dim][part, entry]),
                ],
                ["dim", "part", "entry", "place", "total", "n"],
            )

    return gather


def _first_books(rows: DataFrame, entries: int, parts: int) -> dict[int, np.ndarray]:
    """For each length of vector: parts x entries x width, from the smallest ids."""
    books = {}
    for (dim,) in rows.select("dim").distinct().collect():
        order = F.asc_nulls_last("vec_id"), F.col("vector")
        own = rows.filter(F.col("dim") == dim).orderBy(*order).limit(entries).select("vector").collect()
        width = max(1, -(-dim // parts))
        book = np.zeros((len(own), parts * width), np.int64)
        book[:, :dim] = np.array([r["vector"] for r in own]).reshape(len(own), dim)
        books[dim] = book.reshape(len(own), parts, width).transpose(1, 0, 2).copy()
    return books


def _round(blocks: DataFrame, books: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    sums = blocks.mapInArrow(_gather(books), _SUMS).groupBy("dim", "part", "entry", "place")
    # one row for each component of each codebook
    found = sums.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).filter("n > 0").collect()
    books = {dim: book.copy() for dim, book in books.items()}
    for dim, part, entry, place, total, n in found:
        books[dim][part, entry, place] = total // n  # floors negative means as well
    return books


def digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def _code(books: dict[int, np.ndarray]):
    digests = {dim: digest(book) for dim, book in books.items()}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, 1):
            block = _Block(row)
            found = [block.assign(part, book) for part, book in enumerate(books[block.dim])]
            codes = np.stack([nearest for nearest, _ in found], axis=1).astype(np.uint8)
            text = codes.tobytes().hex()
            size = 2 * codes.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    row.column("vec_ids").flatten(),
                    row.column("labels").flatten(),
                    pa.array([text[i : i + size] for i in range(0, len(text), size)]),
                    pa.array(sum(away for _, away in found)),
                    pa.array([digests[block.dim]] * block.n),
                ],
                ["vec_id", "label", "code", "error", "codebooks_sha256"],
            )

    return code


_CODED = "vec_id long, label long, code string, error long, codebooks_sha256 string"


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """(vec_id, label, code, error, codebooks_sha256) of each usable row, and the codebooks by vector length.

    vectors: (vec_id, embedding, label). At most 256 entries, for two hex digits a part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows = usable(vectors)
    books = _first_books(rows, entries, parts)
    blocks = stored(rows.mapInArrow(_blocks(parts), _BLOCK))
    for _ in range(rounds):
        books = _round(blocks, books)
    return blocks.mapInArrow(_code(books), _CODED), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the sum of errors over equal labels, nulls together."""
    coded = stored(coded)
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    )


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """For tables whose vectors have one length that parts divide, within LIMIT."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
away{r} AS (
  SELECT c.rid, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v)) AS away
  FROM cells c JOIN book{r} b USING (part, place) GROUP BY c.rid, c.part, b.entry),
near{r} AS (
  SELECT rid, part, first(entry ORDER BY away, entry) AS entry, min(away) AS away
  FROM away{r} GROUP BY rid, part)""")
        if r < rounds:
            steps.append(f"""
book{r + 1} AS (
  SELECT b.part, b.entry, b.place, coalesce(m.v, b.v) AS v
  FROM book{r} b LEFT JOIN (
    SELECT part, entry, place, CAST(floor(sum(c.v)::DECIMAL(30,0) / count(*)) AS BIGINT) AS v
    FROM near{r} JOIN cells c USING (rid, part) GROUP BY part, entry, place) m USING (part, entry, place))""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS vector,
         row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (
  SELECT rid, (i - 1) // (len(vector) // {parts}) AS part, (i - 1) % (len(vector) // {parts}) AS place, vector[i] AS v
  FROM (SELECT rid, vector, unnest(range(1, len(vector) + 1)) AS i FROM kept)),
book0 AS (SELECT part, rid AS entry, place, v FROM cells WHERE rid < {entries}),{','.join(steps)},
coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(away) AS BIGINT) AS error
  FROM near{rounds} GROUP BY rid),
books AS (SELECT sha256(string_agg(v, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid) CROSS JOIN books
"""


ORACLE_SQL = _oracle()
