import math

import numpy as np
import pytest

from listing_lake.llm import codes, negatives
from listing_lake.llm.common import table
from listing_lake.llm.queries import queries

SCHEMA = "vec_id long, embedding array<double>, label int, shard int, score long, cell int"
SF = "/root/testdata/sf0.01"


def brute(rows, every=negatives.EVERY, positives=5, count=3, low=50, high=95):
    kept = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            row = (label, [math.floor(codes.SCALE * x) for x in v])
            kept[i] = min(row, kept.get(i, row))
    found = set()
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scores = [
            (-sum(x * y for x, y in zip(v, w)), i, other)
            for i, (other, w) in kept.items()
            if i != a and len(w) == len(v)
        ]
        scores.sort()
        for minus, p, _ in [s for s in scores if s[2] == label][:positives]:
            inside = [s for s in scores if s[2] != label and -low * minus <= -100 * s[0] <= -high * minus]
            for rank, (score, n, _) in enumerate(inside[:count], start=1):
                found.add((a, p, rank, n, -minus, -score))
    return found


def run(spark, rows, **args):
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    found = [tuple(r) for r in negatives.mine(frame, **args).collect()]
    assert len(found) == len(set(found))
    return set(found)


def vectors(kind, n=900, dim=12):
    rng = np.random.default_rng(6)
    if kind == "one-hot":
        found = np.eye(dim)[rng.integers(0, dim, n)]
    elif kind == "binary":
        found = rng.integers(0, 2, (n, dim))
    elif kind == "low rank":
        found = rng.normal(size=(n, 3)) @ rng.normal(size=(3, dim))
    elif kind == "clusters":
        found = rng.normal(size=(20, dim))[rng.integers(0, 20, n)] + 0.05 * rng.normal(size=(n, dim))
    elif kind == "one vector":
        found = np.where(rng.random(n)[:, None] < 0.4, np.ones(dim), rng.normal(size=(n, dim)))
    else:
        found = rng.normal(size=(n, dim))
    labels = rng.integers(0, 4, n)
    return [(i, v, int(label)) for i, (v, label) in enumerate(zip(found.astype(float).tolist(), labels))]


@pytest.mark.parametrize("kind", ["plain", "one-hot", "binary", "low rank", "clusters", "one vector"])
def test_equals_brute_force_over_shards(spark, kind):
    rows = vectors(kind)
    assert run(spark, rows, every=10, shard=128, cells=5) == brute(rows, every=10)


def test_one_shard_and_other_windows(spark):
    rows = vectors("plain", 400)
    args = dict(every=7, positives=2, low=10, high=99)
    assert run(spark, rows, negatives=6, **args) == brute(rows, count=6, **args)


def test_few_partners(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.7, 0.0], 2), (50, [0.0, 1.0], 3), (3, [0.6, 0.1], 2)]
    assert run(spark, rows) == brute(rows) and run(spark, rows)


def test_odd_rows(spark):
    rows = vectors("plain", 300, 4)
    rows += [(300, None, 1), (350, [None] * 4, 1), (400, [math.nan] * 4, 1), (450, [math.inf] * 4, 1)]
    rows += [(500, [1.0] * 4, None), (None, [1.0] * 4, 1), (550, [0.0] * 4, 1), (600, [], 1), (601, [], 1), (602, [], 2)]
    rows += [(0, [0.5] * 4, 0), (0, [0.25] * 4, 0), (650, [1.0, 2.0], 1), (651, [2.0, 2.0], 1), (652, [1.0, 1.5], 0)]
    rows += rows[:40]
    assert run(spark, rows, shard=64) == brute(rows)


def test_no_rows(spark):
    assert run(spark, []) == set()
    assert run(spark, [(50, [1.0], 1)]) == set()


def test_pruning_skips_and_stays_exact():
    rng = np.random.default_rng(4)
    centers = rng.integers(-2000, 2000, (12, 3))
    points = (centers[rng.integers(0, 12, 3000)] + rng.integers(-50, 50, (3000, 3))).astype(float)
    ids, labels = np.arange(3000) * 3, rng.integers(0, 3, 3000)
    tree = negatives.build(ids, labels, points, float((points**2).sum(axis=1).max()))
    asked = np.arange(0, 3000, 20)
    scores = points[asked] @ points.T
    low, high = np.quantile(scores, [0.7, 0.72], axis=1)
    search = negatives.Search(
        tree, ids[asked], labels[asked], points[asked], low[:, None], high[:, None], 5, False
    )
    assert search.compared < 0.5 * scores.size
    row, _, vec, score = search.result()
    for n, a in enumerate(asked):
        fits = [i for i in range(3000) if labels[i] != labels[a] and low[n] <= scores[n, i] <= high[n]]
        want = sorted((-scores[n, i], ids[i]) for i in fits)[:5]
        assert sorted(zip(-score[row == n], vec[row == n])) == want


def test_query_changes_labels_before_mining(spark):
    rows = [
        (r.vec_id, list(map(float, r.embedding)), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in table(spark, SF, "embeddings").collect()
    ]
    assert {tuple(r) for r in queries()["op13_hard_negatives"](spark, SF).collect()} == brute(rows)
