import zlib
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from listing_lake.llm import token_store as ts
from listing_lake.llm.common import table
from listing_lake.session import work_dir

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\n  x", "a" * 5000, "don't WE'LL ''s '", "x²³½ Ⅷ é 漢字かな 🙂👩‍🚀", "tab\tnbsp\xa0 end \x1c\x1d!",
    "a <|endoftext|> b<|startoftext|>c <|ENDOFTEXT|>", "İı ſ ΣΑΣ Ǻ", "word " * 9000, " lead\x0band\x0c\x85trail  ",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(ts.TOKENIZER)


def expected(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [ts.END]


@cache
def remembered():
    return ts._Ids(ts.TOKENIZER)


def encoded(text):
    ids = remembered()
    return np.frombuffer(ts.encode(text, ids), ids.kind).tolist()


def test_ids_equal_the_library(tokenizer, monkeypatch):
    monkeypatch.setattr(ts, "CHUNK", 64)
    monkeypatch.setattr(ts, "REMEMBERED", 3)
    for text in ODD:
        assert encoded(text) == expected(tokenizer, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_ids_equal_the_library_on_any_text(tokenizer, text):
    assert encoded(text) == expected(tokenizer, text)


LATIN = "".join(map(chr, [*range(32, 127), *range(0xC0, 0x250)]))


@settings(max_examples=500, deadline=None)
@given(st.text(LATIN + "''stremvld  ", max_size=60))
def test_ids_equal_the_library_on_latin_text(tokenizer, text):
    assert encoded(text) == expected(tokenizer, text)


def test_every_latin_character(tokenizer):
    for c in LATIN:
        for text in (c, f"a{c}b", f"{c}{c}", f"'{c}"):
            assert encoded(text) == expected(tokenizer, text)


def test_other_tokenizer_files_go_through_the_library(monkeypatch):
    monkeypatch.setattr(ts, "_STEPS", {"split": "another"})
    ids = ts._Ids(ts.TOKENIZER)
    assert ts.encode("Word's  end", ids) == ts.encode("Word's  end", remembered()) and not ids.words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1) | st.integers(0, 50), max_size=60), st.randoms())
def test_elias_fano_holds_any_sequence(values, random):
    values = np.array(sorted(values), np.int64)
    data = b"junk" + ts.EliasFano.of(values).to_bytes() + b"more"
    found, at = ts.EliasFano.read(memoryview(data), 4)
    places = np.array(random.sample(range(len(values)), len(values)), np.int64)
    assert at == len(data) - 4 and (found[places] == values[places]).all()


def test_select_over_many_samples_and_size():
    rng = np.random.default_rng(3)
    ends = np.cumsum(rng.integers(0, 900, 50_000))
    code = ts.EliasFano.of(ends)
    places = rng.permutation(len(ends))[:999]
    assert (code[places] == ends[places]).all()
    bits = 8 * len(code.to_bytes()) / len(ends)
    assert bits < 2.1 + np.log2(ends[-1] / len(ends))


def run(spark, frame, **args):
    folder = work_dir(spark, "ids")
    ts.write(frame, folder, **args)
    return ts.read(spark, folder, keep_ids=True).collect()


def check(rows, docs, tokenizer):
    """docs: (doc_id, text); rows that share an id may come in any order."""
    ids = [tuple(expected(tokenizer, t)) for _, t in docs]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(((r.doc_id, tuple(r.ids)) for r in rows), key=lambda r: (key(r), r[1])) == sorted(
        zip([d for d, _ in docs], ids), key=lambda r: (key(r), r[1])
    )
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    in_order = [key(r) for r in sorted(rows, key=lambda r: r.start)]
    assert in_order == sorted(in_order)


@pytest.mark.parametrize("shard", [ts.SHARD, 2000, 1])
def test_round_trip(spark, tokenizer, shard):
    docs = table(spark, SF, "documents")
    check(run(spark, docs, shard=shard), [(r.doc_id, r.text) for r in docs.collect()], tokenizer)


def test_odd_rows(spark, tokenizer):
    rows = [(i * 10**17 - 9 * 10**17, t) for i, t in enumerate(ODD)]
    rows += [(None, "no id"), (None, None), (3, "first"), (3, "second"), (3, "first"), (2**63 - 1, "x"), (-(2**63), "y")]
    rows += [(7, "the same")] * 300
    extra = [(i, t, 1, 2, "a") for i, t in rows]
    frame = spark.createDataFrame(extra, "doc_id long, text string, start long, part int, version string").repartition(5)
    check(run(spark, frame, shard=150), rows, tokenizer)


def test_no_rows(spark):
    assert run(spark, spark.createDataFrame([], "doc_id long, text string")) == []


def test_equal_rows_are_dealt_out(spark):
    frame = spark.range(4000).selectExpr("7L AS doc_id", "'the same text' AS text")
    folder = work_dir(spark, "ids")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ts.write(frame, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["ids"] for r in ts._files(spark, folder).select("ids").collect()]
    assert len(sizes) > 1 and max(sizes) < sum(sizes) / 2
