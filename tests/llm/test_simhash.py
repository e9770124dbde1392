import random

import numpy as np
import xxhash

from listing_lake.llm import simhash
from listing_lake.llm.common import components, table

SF = "/root/testdata/sf0.001"


def plain(text):
    """The definition, word by word."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(ids, fps):
    """Components by comparing all pairs."""
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, doc in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, doc), doc)
    return [least[find(i)] for i in range(len(ids))]


def test_fingerprint(monkeypatch):
    texts = [None, "", " \t\n", "one", "One two", "a b c d", "É x\x0by\x1cz É x", "AbC " * 700, "w x y z"]
    texts += [" ".join(random.Random(i).choices("abcdefgh", k=i)) for i in range(2, 40)]
    for chunk in (simhash.CHUNK, 16):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        assert [simhash.fingerprint(t) for t in texts] == [plain(t) for t in texts]


def test_golay_is_perfect():
    starts, patterns = simhash._rings()[0]
    assert (np.diff(starts) == 1).all() and len(patterns) == 2048
    words = np.random.default_rng(1).integers(0, 1 << 23, 500)
    _, code = simhash._near(words, 0)
    assert (simhash._syndrome(code) == 0).all()
    assert max(int(x).bit_count() for x in words ^ code) <= 3


def test_every_close_pair_meets_at_an_anchor():
    rng = np.random.default_rng(2)
    fps = rng.integers(-(2**63), 2**63, 400, dtype=np.int64)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 3), replace=False)) for _ in fps]
    near = fps ^ np.array(flips, np.uint64).view(np.int64)
    _, homes = simhash._anchors(fps, 0)
    index, probes = simhash._anchors(near, simhash.THRESHOLD)
    for i, home in enumerate(homes):
        assert home in probes[index == i]


def test_anchors_are_not_broadcast(spark):
    fps = spark.range(50).selectExpr("xxhash64(id) AS fp")
    plan = simhash.links(fps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(201, 200), (5, 5), (1, 0)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 50)}, 201: 200}


def test_documents_against_all_pairs(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in simhash.near_duplicates(table(spark, SF, "documents")).collect()}
    fps = [plain(r.text) for r in rows]
    assert [found[r.doc_id].fingerprint for r in rows] == [f"{f:016x}" for f in fps]
    assert [found[r.doc_id].component_id for r in rows] == roots([r.doc_id for r in rows], fps)


def test_odd_rows(spark):
    rows = [(7, None), (3, ""), (9, " \n"), (4, "a b c d e f"), (4, "a b c d e f"), (6, "A b  C d e f"), (None, "a b c d e f")]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fp int, component_id int")
    found = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(frame).collect())
    assert found == [(-1, 4), (3, 3), (4, 4), (4, 4), (6, 4), (7, 3), (9, 3)]
    kept = sorted(r.doc_id or -1 for r in simhash.keep_one(frame).collect())
    assert kept == [-1, 3, 4, 4]
    assert simhash.near_duplicates(frame.limit(0)).collect() == []
