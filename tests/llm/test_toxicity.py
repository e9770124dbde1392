import math
import zlib

import numpy as np

from listing_lake.llm import toxicity as tox
from listing_lake.llm.common import table
from listing_lake.session import stored

SF = "/root/testdata/sf0.1"
DOCS, LABELS = "doc_id long, text string, toxic int, slot int", "doc_id long, toxic int, text string"


def test_ratio_is_kneser_ney(spark):
    texts = [("good day good people", 0), ("good bad day", 0), ("bad bad fool", 1), ("fool day one", 1), ("rare", None)]
    frame = spark.createDataFrame(texts, "text string, toxic int")
    counts = frame.mapInArrow(tox._count, "word long, ordinary long, toxic long, held long").groupBy("word").sum()
    counts = stored(counts.toDF("word2", "word", "ordinary", "toxic", "held").selectExpr("word2 AS word", "ordinary", "toxic", "held"))
    model = tox._ratios(counts)
    known = tox._Known(model)
    words = [[w for t, y in texts if y == c for w in t.split()] for c in (0, 1)]
    held = [w for t, _ in texts for w in set(t.split())]

    def p(word, c):
        n = {w: words[c].count(w) for w in words[c]}
        once, twice = (sum(v == k for v in n.values()) for k in (1, 2))
        d = once / (once + 2 * twice)
        shared = (held.count(word) + tox.UNSEEN) / (len(held) + 1)
        return max(n.get(word, 0) - d, 0) / len(words[c]) + d * len(n) / len(words[c]) * shared

    for word in set(held):
        assert math.isclose(known[word], math.log(p(word, 1) / p(word, 0)), rel_tol=1e-5)
    assert math.isclose(known["never"], math.log(p("never", 1) / p("never", 0)), rel_tol=1e-5)
    labelled = {w for side in words for w in side}
    assert len(model.words) == len(labelled)  # "rare" has no label, and the ratio of words never seen
    assert math.isclose(known["rare"], model.unseen) and "rare" not in labelled


def test_no_two_words_share_a_count(spark):
    """Many more words than a table of 2 ** 22 slots could tell apart in pairs."""
    many = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{chr(97 + i // 17576)}" for i in range(26**3)]
    frame = spark.createDataFrame([(" ".join(many), 1), ("plain", 0)], "text string, toxic int")
    counts = frame.mapInArrow(tox._count, "word long, ordinary long, toxic long, held long")
    assert counts.count() == len(set(many)) + 1 and counts.groupBy().max("toxic", "held").first()[:] == (1, 1)
    assert all(-(1 << 63) <= tox._key(w) < 1 << 63 for w in many)


def test_held_out_precision_and_recall(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = stored(tox.score(docs, labels))
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= tox.CUTOFF)
    tested = [r for r in rows if r.held_out]
    hit = sum(r.predicted and r.toxic for r in tested)
    assert hit / sum(r.toxic for r in tested) > 0.9
    assert hit / sum(r.predicted for r in tested) > 0.75


def _made(n=400):
    rng = np.random.default_rng(0)
    docs = [(i, " ".join(rng.choice(["sun", "moon", "tree", "lake"], rng.integers(2, 60))) + (" idiot scum" if i % 5 == 0 else ""), 9, 9) for i in range(n)]
    return docs, [(i, int(i % 5 == 0), "x") for i in range(n)]


def test_odd_rows(spark):
    docs, labels = _made()
    docs += [(1000, None, 0, 0), (1001, "", 0, 0), (1002, "12 !!", 0, 0), (None, "idiot scum tree", 0, 0), (1003, "lake", 0, 0), (1003, "lake", 0, 0), (1004, "sun moon " * 50_000 + "idiot scum", 0, 0)]
    labels += [(0, 0, "x"), (1, None, "x"), (None, 1, "x"), (5000, 1, "x")]
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    found = tox.score(frame, marks).collect()
    assert len(found) == len(docs)
    by = {r.doc_id: r for r in found}
    assert [by[i].predicted for i in (1000, 1001, 1002, 1003, 1004)] == [0, 0, 0, 0, 1]
    assert by[None].predicted == 1 and by[5].predicted == 1 and by[6].predicted == 0
    kept = {r.doc_id for r in tox.accepted(frame, marks).collect()}
    assert kept == {d[0] for d in docs if d[0] is None or (d[0] >= 400 or d[0] % 5)} - {1004}


def test_labels_of_held_out_documents_are_not_read(spark):
    docs, labels = _made()
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t, x) for i, t, x in labels]
    frame = spark.createDataFrame(docs, DOCS)
    a, b = ({r.doc_id: r.score for r in tox.score(frame, spark.createDataFrame(ls, LABELS)).collect()} for ls in (labels, turned))
    assert all(math.isclose(a[i], b[i], rel_tol=1e-9) for i in a)


def test_no_labels_and_no_rows(spark):
    frame, none = spark.createDataFrame([(1, "a b", 0, 0)], DOCS), spark.createDataFrame([], LABELS)
    assert [r.score for r in tox.score(frame, none).collect()] == [0.5]
    assert tox.score(frame.limit(0), none).collect() == []
