import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from listing_lake.llm import packing
from listing_lake.llm.common import table

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\n  x", "a" * 5000, "don't we'll", "x²³½ Ⅷ é̀ 漢字かな 🙂👩‍🚀", "tab\tnbsp  end \x1c\x1d",
    "<|endoftext|> text", "a <|endoftext|> b <|endoftext|><|endoftext|>", " <|endoftext| > <|endoftext|>  \n", "¿Qué? 1234 __a_b__ İı ſ", "word " * 9000, " lead and trail  ",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.TOKENIZER)


def expected(tokenizer, texts):
    return [e.ids + [0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_the_tokenizers(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 64)
    found = [np.frombuffer(b, "<u4").tolist() for b in packing.encode(ODD)]
    assert found == expected(tokenizer, ODD)


def test_remembered_words_stay_right_when_forgotten(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    texts = ["one two three four", "five one six", "one two", "seven eight nine ten eleven"]
    found = [np.frombuffer(b, "<u4").tolist() for b in packing.encode(texts)]
    assert found == expected(tokenizer, texts)


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    rng, size = random.Random(seed), 64
    counts = {rng.randint(1, size): rng.randint(1, 40) for _ in range(rng.randint(1, 40))}
    used: dict[int, int] = {}
    sequences = 0
    for pattern, times in packing.plan(counts, size):
        assert times > 0 and sum(x * n for x, n in pattern) <= size
        sequences += times
        for x, n in pattern:
            used[x] = used.get(x, 0) + n * times
    assert used == counts
    assert -(-sum(x * n for x, n in counts.items()) // size) <= sequences <= 1.05 * first_fit(counts, size) + 1


def first_fit(counts, size):
    """Sequences of first-fit decreasing, piece by piece."""
    room: list[int] = []
    for x in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fits = [i for i, free in enumerate(room) if free >= x]
        if fits:
            room[fits[0]] -= x
        else:
            room.append(size - x)
    return len(room)


def test_exact_complements_are_found():
    assert packing.plan({60: 5, 4: 5}, 64) == [(((60, 1), (4, 1)), 5)]
    assert packing.plan({40: 2, 14: 2, 10: 2}, 64) == [(((40, 1), (14, 1), (10, 1)), 2)]
    assert packing.plan({30: 3, 20: 3, 9: 3, 5: 3}, 64) == [(((30, 1), (20, 1), (9, 1), (5, 1)), 3)]


def check(rows, docs, tokenizer, size=packing.SEQUENCE):
    ids = {i: e for i, e in zip([d[0] for d in docs], expected(tokenizer, [d[1] for d in docs]))}
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        at = 0
        for n, r in enumerate(pieces):
            assert (r.piece, r.start) == (n, at)
            own = np.array(ids[doc][at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(own)
            assert r.length == size or n == 0
            at += r.length
        assert at == len(ids[doc])
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    total = sum(map(len, ids.values()))
    return len(by_sequence), -(-total // size)


def test_documents(spark, tokenizer):
    docs = table(spark, SF, "documents")
    rows = packing.pack(docs).collect()
    used, least = check(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert used <= 1.03 * least + 1


def test_odd_texts_and_clashing_columns(spark, tokenizer):
    docs = [(i, t) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame(
        [(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, part int, rank int, length int"
    )
    check(packing.pack(frame).collect(), docs, tokenizer)
    check(packing.pack(frame, size=16).collect(), docs, tokenizer, 16)
    kept = packing.pack(frame, keep_ids=True).filter("doc_id = 8").collect()
    assert kept[0].ids == expected(tokenizer, [ODD[8]])[0]


def test_repeated_and_empty(spark, tokenizer):
    frame = spark.createDataFrame([(1, "same"), (1, "same"), (None, "x")], "doc_id long, text string")
    rows = packing.pack(frame).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack(frame.limit(0)).collect() == []
