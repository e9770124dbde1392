import random

import numpy as np
import pytest

from listing_lake.llm import decontam as dc
from listing_lake.llm.common import table

SF = "/root/testdata/sf0.01"
DOCS, ITEMS = "doc_id long, text string, item_id int, bad_id int", "item_id long, text string, doc_id int"


def distance(item, text):
    """Sellers' algorithm, cell by cell."""
    row = [0] * (len(text) + 1)
    for n, word in enumerate(item, start=1):
        below = [n]
        for j, other in enumerate(text, start=1):
            below.append(min(row[j] + 1, below[-1] + 1, row[j - 1] + (word != other)))
        row = below
    return min(row)


def brute(docs, items):
    found = {}
    for doc, text in docs:
        words = dc.words_of(text)
        for item, other in items:
            want = dc.words_of(other)
            if want and (d := distance(want, words)) <= int(dc.DISTANCE * len(want)):
                found[doc, item] = d
    return found


def run(spark, docs, items, **args):
    frame = spark.createDataFrame([(*d, 1, 1) for d in docs], DOCS)
    rows = dc.contaminated(frame, spark.createDataFrame([(*i, 1) for i in items], ITEMS), **args).collect()
    return {(r.doc_id, r.item_id): r.edit_distance for r in rows}


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        item, text = ([rng.randint(0, 3) for _ in range(rng.randint(a, 9))] for a in (1, 0))
        assert dc.edit_distance(np.array(item), np.array(text, int)) == distance(item, text)


def test_documents_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").limit(150).collect()]
    docs += [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect() if len(r.text) < 900][:250]
    docs = list({d[0]: d for d in docs}.values())
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert run(spark, docs, items) == brute(docs, items)


def test_whole_table_finds_every_contained_item(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, items).collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    held = {(d, r.item_id) for r in items.collect() for d, t in texts if r.text in t}
    assert held and held <= found


def _edited(words, rate, rng):
    words = list(words)
    for _ in range(max(1, int(rate * len(words)))):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = f"new{rng.randrange(10**6)}"
        elif kind == 1:
            words.insert(at, f"more{rng.randrange(10**6)}")
        else:
            del words[at]
    return words


def test_recall_of_edited_items():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, rng.choices(vocabulary, k=rng.randint(14, 80))) for i in range(150)]
    index = dc.Index(items)
    known = dc._Codes()
    for rate, least in ((0.05, 0.97), (0.1, 0.95)):
        hits = 0
        for number, (_, words) in enumerate(items):
            around = rng.choices(vocabulary, k=150)
            at = rng.randrange(151)
            text = around[:at] + _edited(words, rate, rng) + around[at:]
            codes = np.array([known[w] for w in text], np.uint64)
            hits += (0, number) in dc.matches(index, codes, np.array([len(text)]), dc.DISTANCE)
        assert hits / len(items) >= least
    assert dc.repetitions_for(0.95, 0.4) == 6


def test_odd_rows(spark, monkeypatch):
    phrase = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    items = [(1, phrase), (2, "Short one"), (3, None), (4, ""), (5, "..."), (6, "single"), (1, "another text of the first id"), (None, "null id item text"), (7, phrase)]
    docs = [
        (10, phrase), (11, "x " * 40_000 + phrase.upper() + " y" * 9), (12, None), (13, ""), (14, "a short one b"),
        (None, phrase), (15, "single"), (16, "clean text that holds nothing of the kind"), (10, phrase), (17, phrase.rsplit(" ", 2)[0]),
        (18, "null id item text"), (19, "another text of the first id"),
    ]
    want = {(d, i): 0 for d in (10, 11, None) for i in (1, 7)}
    want |= {(14, 2): 0, (15, 6): 0, (17, 1): 2, (17, 7): 2, (18, None): 0, (19, 1): 0}
    assert run(spark, docs, items) == want
    monkeypatch.setattr(dc, "BLOCK", 60)  # several blocks of items
    assert run(spark, docs, items) == want
    frame = spark.createDataFrame([(*d, 1, 1) for d in docs], DOCS)
    marks = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    assert sorted(r.doc_id or 0 for r in dc.clean(frame, marks).collect()) == [0, 12, 13, 16]
    assert run(spark, [], items) == {} and run(spark, docs, []) == {}


def _evenly_edited(words, rng):
    """The most edits that the distance allows, evenly spread."""
    words, count = list(words), int(dc.DISTANCE * len(words))
    for i in reversed(range(count)):
        at, kind = int((i + 0.5) * len(words) / count), rng.randrange(3)
        words[at : at + (kind != 1)] = [] if kind == 2 else [f"new{rng.randrange(10**9)}"]
    return words


@pytest.mark.parametrize("n", [5, 7, 10, 14])
def test_shares_proposed_by_one_repetition_and_by_all(n, monkeypatch):
    """The measured share that the number of repetitions rests on, and what they reach together."""
    rng = random.Random(n)
    items = [(i, [f"w{rng.randrange(10**9)}" for _ in range(n)]) for i in range(1000)]
    texts = [[f"a{i}"] * 9 + _evenly_edited(words, rng) + [f"b{i}"] * 9 for i, words in items]
    known = dc._Codes()
    parts = [np.array([known[w] for w in t], np.uint64) for t in texts]
    codes, ends = np.concatenate(parts), np.cumsum([*map(len, parts)])
    share = next(hit for least, *_, hit in dc.SIZES if n >= least)

    def proposed():
        docs, numbers, _ = dc.Index(items).candidates(codes, ends)
        return np.unique(docs[docs == numbers]).size / len(items)

    assert proposed() >= 0.99
    all_of = dc.windows_of
    single = []
    for repetition in range(len(all_of(n).samples)):
        one = dc.Windows(all_of(n).words, all_of(n).samples[repetition : repetition + 1])
        monkeypatch.setattr(dc, "windows_of", lambda *_: one)
        single.append(proposed())
    assert np.mean(single) >= share


def test_walks_meet_again_after_an_insertion():
    """Of windows that differ by a word put in front, more show the same words than by chance."""
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**32, (3000, 6)).astype(np.uint32)
    more = np.concatenate([rng.integers(0, 2**32, (3000, 1)).astype(np.uint32), words[:, :5]], axis=1)
    windows = dc.Windows(6, ((3, 5),))
    keys = [dc._keys(w.ravel(), windows, 0).reshape(-1, 6)[:, 0] for w in (words, more)]
    assert 0.1 < np.mean((keys[0] == keys[1]) & (keys[0] != 0)) < 0.6


def test_no_edits_allowed(spark):
    phrase = " ".join(f"w{i}" for i in range(30))
    docs = [(1, f"x {phrase} y"), (2, phrase.replace("w29", "z")), (3, phrase)]
    assert run(spark, docs, [(7, phrase)], distance=0.0) == {(1, 7): 0, (3, 7): 0}


def _replaced(words, count, where, rng):
    """count words replaced: the first, the last, or spread from end to end."""
    at = {"start": range(count), "end": range(len(words) - count, len(words))}
    spread = sorted(rng.sample(range(len(words)), count))
    return [f"new{rng.randrange(10**6)}" if i in at.get(where, spread) else w for i, w in enumerate(words)]


@pytest.mark.parametrize("where", ["start", "end", "spread"])
def test_every_item_within_the_distance_is_found(where):
    """Up to 20 % edits, wherever they are, on items of 5 to 300 words."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, rng.choices(vocabulary, k=n)) for i, n in enumerate([*range(5, 80), 120, 200, 300] * 2)]
    index, known = dc.Index(items), dc._Codes()
    texts, parts = [], []
    for _, words in items:
        around = rng.choices(vocabulary, k=100)
        texts.append(around[:50] + _replaced(words, int(dc.DISTANCE * len(words)), where, rng) + around[50:])
        parts.append(np.array([known[w] for w in texts[-1]], np.uint64))
    found = dc.matches(index, np.concatenate(parts), np.cumsum([*map(len, parts)]), dc.DISTANCE)
    for number, (_, words) in enumerate(items):
        assert found.get((number, number)) == distance(words, texts[number])


def test_random_edits_up_to_the_distance_against_all_pairs(monkeypatch):
    monkeypatch.setattr(dc, "PLACES", 50)  # many small steps
    monkeypatch.setattr(dc, "AROUND", 90)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, rng.choices(vocabulary, k=rng.randint(1, 40))) for i in range(60)]
    docs = []
    for _, words in items:
        around = rng.choices(vocabulary, k=40)
        docs.append(around[:20] + _edited(words, rng.choice([0.0, 0.1, 0.2]), rng) + around[20:])
    index, known = dc.Index(items), dc._Codes()
    parts = [np.array([known[w] for w in d], np.uint64) for d in docs]
    found = dc.matches(index, np.concatenate(parts), np.cumsum([*map(len, parts)]), dc.DISTANCE)
    want = {
        (d, i): e
        for d, text in enumerate(docs)
        for i, words in items
        if (e := distance(words, text)) <= int(dc.DISTANCE * len(words))
    }
    assert found == want
