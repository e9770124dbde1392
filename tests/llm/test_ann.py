import math

import numpy as np
import pytest

from listing_lake.llm import ann
from listing_lake.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, part int"


def brute(rows, k=ann.K, every=ann.EVERY):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], float)
    found = {}
    for i, v in rows:
        if i % every == 0:
            scores = (vectors * np.array(v, float)).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            found[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def run(frame, **args):
    found: dict = {}
    for r in ann.nearest(frame, **args).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for rows in found.values():
        assert [r[0] for r in sorted(rows)] == list(range(1, len(rows) + 1))
    return {q: [(v, s) for _, v, s in sorted(rows)] for q, rows in found.items()}


def same(found, want):
    assert set(found) == set(want)
    for q in want:
        assert [v for v, _ in found[q]] == [v for v, _ in want[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_factor_one_is_exact_over_shards_and_blocks(spark):
    frame = table(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    same(run(frame, factor=1.0, shard=150, block=9), brute(rows))


def test_default_recall(spark):
    frame = table(spark, SF, "embeddings")
    want = brute([(r.vec_id, r.embedding) for r in frame.collect()])
    found = run(frame)
    shares = [len({v for v, _ in found[q]} & {v for v, _ in w}) / len(w) for q, w in want.items()]
    assert np.mean(shares) >= 0.95


def structured(kind, n=1200, dim=64):
    """Unit vectors with a decaying spectrum or of low rank."""
    rng = np.random.default_rng(8)
    if kind.startswith("rank"):
        rank = int(kind.split()[1])
        vectors = rng.normal(size=(n, rank)) @ rng.normal(size=(rank, dim))
    else:
        vectors = rng.normal(size=(n, dim)) * np.arange(1, dim + 1) ** -float(kind.split()[1])
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


@pytest.mark.parametrize("kind", ["power 1", "power 0.5", "rank 4", "rank 8", "rank 16"])
def test_default_finds_all_on_structured_vectors(spark, kind):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(structured(kind))]
    found = run(spark.createDataFrame(rows, "vec_id long, embedding array<double>, part int"))
    same(found, brute([(i, v) for i, v, _ in rows]))


def test_pruning_skips_and_stays_exact_on_clustered_vectors():
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, 3)) * 20
    vectors = centers[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 3))
    ids = np.arange(3000)
    tree = ann.build(ids, vectors, float(np.sqrt((vectors**2).sum(axis=1).max())))
    asked = ids[::20]
    search = ann.Search(tree, asked, vectors[asked], 20, 1.0)
    assert search.compared < 0.75 * len(asked) * len(ids)
    query, vec, score = search.result()
    want = brute(list(zip(ids.tolist(), vectors)))
    for q in asked:
        assert [int(v) for v in vec[query == q]] == [v for v, _ in want[int(q)]]
    assert ann.Search(tree, asked, vectors[asked], 20, 3.0).compared <= search.compared


@pytest.mark.parametrize("kind", ["binary", "one-hot", "integers", "one component"])
def test_ties_between_unequal_vectors(spark, kind):
    rng, n, dim = np.random.default_rng(2), 1500, 24
    vectors = {
        "binary": rng.integers(0, 2, (n, dim)),
        "one-hot": np.eye(dim)[rng.integers(0, dim, n)],
        "integers": rng.integers(-3, 4, (n, dim)),
        "one component": np.column_stack([np.ones(n), np.zeros((n, dim - 2)), rng.normal(size=n)]),
    }[kind].astype(float)
    if kind == "one component":
        vectors[::20, -1] = 0.0  # queries see the first component only
    order = rng.permutation(n)
    rows = [(int(i), v.tolist(), 0) for i, v in zip(order, vectors) if v.any()]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, part int")
    same(run(frame, shard=400, block=16), brute([(i, v) for i, v, _ in rows]))


def test_equal_vectors_and_ties(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(300)] + [(300 + i, [0.0, float(i % 3)], 0) for i in range(1, 80)]
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = [(i, v) for i, v, _ in rows if any(v)]
    same(run(frame, factor=1.0, shard=64, block=4), brute(kept))


@pytest.mark.parametrize("factor", [1.0, ann.FACTOR])
def test_odd_vectors_take_no_part(spark, factor):
    good = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [-1.0, 0.5]), (41, [0.125, 0.125])]
    bad = [(40, None), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [math.nan, 1.0]), (120, [math.inf, 1.0]), (140, []), (None, [1.0, 1.0])]
    repeated = [(1, [2.0, 1.0]), (20, [5.0, 5.0])]  # the smaller vector of an id counts
    other = [(160, [1.0, 0.0, 0.0]), (161, [1.0, 1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 7) for i, v in good + bad + repeated + other], SCHEMA)
    want = brute(good)
    want[160] = [(161, 1.0)]
    same(run(frame, factor=factor), want)


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert ann.nearest(frame).collect() == []
    alone = spark.createDataFrame([(20, [1.0], 0)], SCHEMA)
    assert ann.nearest(alone).collect() == []
