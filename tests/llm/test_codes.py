import hashlib
import math

import duckdb
import numpy as np
import pandas as pd
import pytest

from listing_lake.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long"


def brute(rows, parts, entries, rounds):
    """Straight from the definition, one row at a time; vectors of one length."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-len(kept[0][1]) // parts)
    vectors = []
    for _, v, _ in kept:
        v = [math.floor(codes.SCALE * x) for x in v] + [0] * (width * parts - len(v))
        vectors.append([v[p * width : (p + 1) * width] for p in range(parts)])
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[vectors[i][p] for i in first] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for v in vectors:
                own.setdefault(nearest(p, v[p])[1], []).append(v[p])
            for n, group in own.items():
                books[p][n] = [sum(x) // len(group) for x in zip(*group)]
    text = ",".join(str(x) for book in books for e in book for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    found = []
    for (i, _, label), v in zip(kept, vectors):
        best = [nearest(p, v[p]) for p in range(parts)]
        found.append((i, label, "".join(f"{n:02x}" for _, n in best), sum(d for d, _ in best), digest))
    return found


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x or 0) for x in r[:2]) + r[2:])


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "mine", -1) for r in rows], SCHEMA)


def odd_rows(dim, n=150):
    rng = np.random.default_rng(dim)
    rows = [(int(i), (rng.normal(size=dim) * 0.02).tolist(), int(i) % 3) for i in rng.permutation(n)]
    rows += [(n, [0.01] * dim, None), (n, [0.02] * dim, None), (None, [0.5] * dim, 1), (3, [0.0] * dim, 9)]
    rows += [(5000, [-1.5] * dim, 2)] * 40
    bad = [(-1, None, 0), (-2, [None] * dim, 0), (-3, [math.nan] * dim, 0), (-4, [math.inf] * dim, 0)]
    return rows + bad


@pytest.mark.parametrize("dim, parts, entries, rounds", [(8, 4, 6, 2), (6, 4, 300 - 44, 1), (16, 16, 64, 2), (3, 2, 1, 3), (4, 2, 5, 0)])
def test_equals_the_definition(spark, monkeypatch, dim, parts, entries, rounds):
    rows = odd_rows(dim)
    coded, books = codes.compress(frame_of(spark, rows).repartition(3), parts, entries, rounds)
    assert ordered(coded.collect()) == ordered(brute(rows, parts, entries, rounds))
    assert books[dim].shape[0] == parts


def test_label_errors(spark):
    rows = odd_rows(8)
    found = codes.with_label_error(codes.compress(frame_of(spark, rows), 4, 6)[0]).collect()
    sums: dict = {}
    for _, label, _, error, _ in brute(rows, 4, 6, codes.ROUNDS):
        sums[label] = sums.get(label, 0) + error
    labels = {(i, code): label for i, label, code, _, _ in brute(rows, 4, 6, codes.ROUNDS)}
    assert len(found) == len(rows) - 4
    assert {r.label_error for r in found} == set(sums.values())
    assert all(r.label_error == sums[labels[r.vec_id, r.code]] for r in found)


def test_sql_twin_on_odd_rows(spark):
    rows = [(i, (v * 16)[:64] if v else v, label) for i, v, label in odd_rows(4) if i is not None]
    frame = pd.DataFrame(rows, columns=["vec_id", "embedding", "label"])
    connection = duckdb.connect()
    connection.register("embeddings", frame.astype({"label": "Int64"}))
    want = connection.sql(codes.ORACLE_SQL).fetchall()
    found = codes.with_label_error(codes.compress(frame_of(spark, rows))[0]).collect()
    assert sorted(map(tuple, found)) == sorted(want) and len(found) > 100


def test_lengths_are_kept_apart_and_large_values_held(spark):
    rows = [(i, [float(i)] * 4, 0) for i in range(5)] + [(i, [0.25 * i] * 2, 0) for i in range(5, 9)]
    rows += [(20, [1e300, -1e300, 1.0, 0.0], 1), (21, [], 1)]
    found = {r.vec_id: r for r in codes.compress(frame_of(spark, rows), 2, 8)[0].collect()}
    assert len(found) == 11 and found[21].error == 0
    short = brute([r for r in rows if r[1] is not None and len(r[1]) == 2], 2, 8, codes.ROUNDS)
    assert {(r.vec_id, r.code, r.error) for r in found.values()} >= {(i, c, e) for i, _, c, e, _ in short}


def test_no_rows_and_limits(spark):
    assert codes.with_label_error(codes.compress(frame_of(spark, []))[0]).collect() == []
    with pytest.raises(ValueError):
        codes.compress(frame_of(spark, []), entries=257)
