from pyspark.sql import functions as F

import corpus_pipeline
from listing_lake.llm import decontam, linedup, packing, simhash, toxicity
from listing_lake.llm.common import components, table
from listing_lake.llm.queries import oracle_sql, queries
from listing_lake.session import stored

SF = "/root/testdata/sf0.001"


def test_every_stage_takes_effect(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SF))
        assert after.columns == columns and after.schema == docs.schema
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        left = {r.doc_id for r in after.select("doc_id").collect()}
        assert left <= ids
        if name == "toxicity":
            bad = toxicity.score(docs, table(spark, SF, "labels")).filter("predicted = 1")
        elif name == "near_duplicates":
            bad = simhash.near_duplicates(docs).filter("doc_id != component_id")
        elif name == "decontamination":
            bad = decontam.contaminated(docs, table(spark, SF, "benchmark"))
        else:
            bad = docs.limit(0)
            want = {r.doc_id: r.text for r in linedup.drop_recurring(docs).collect()}
            assert {r.doc_id: r.text for r in after.collect()} == want
            assert all(r.n_chars == len(r.text) for r in after.collect() if r.text is not None)
        assert ids - left == {r.doc_id for r in bad.select("doc_id").collect()}
        kept.append(len(left))
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    assert kept == sorted(kept, reverse=True)


def test_near_duplicates_broadcast_no_anchors(spark, monkeypatch):
    seen = []

    def watched(edges):
        seen.append(edges._jdf.queryExecution().executedPlan().toString())
        return components(edges)

    monkeypatch.setattr(simhash, "components", watched)
    corpus_pipeline.near_duplicates(spark, table(spark, SF, "documents"), SF)
    assert len(seen) == 1 and "SortMergeJoin" in seen[0] and "Broadcast" not in seen[0]


def test_run_equals_its_stages(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF))
    want = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in packing.pack(docs).collect()}
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect()} == want


def test_stages_take_odd_and_no_rows(spark):
    schema = table(spark, SF, "documents").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "words in a text", None, None, None)], schema)
    for rows, n in ((odd, 4), (odd.limit(0), 0)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF))
        assert (docs.count() > 0) == (n > 0)


def test_rows_that_share_an_id_are_judged_one_by_one(spark):
    t, u = "one text of a few plain words here", "another one that differs in every word"
    near = spark.createDataFrame([(1, u), (5, t), (5, u), (7, t), (9, "a third"), (5, "a third"), (5, t)], "doc_id long, text string")
    kept = sorted(map(tuple, simhash.keep_one(near).collect()))
    assert kept == [(1, u), (5, "a third"), (5, t), (5, t)]

    item = " ".join(f"item{i}" for i in range(12))
    docs = [(1, f"before {item} after"), (1, "clean words"), (2, "clean words"), (None, item), (None, "clean")]
    frame = spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id long, text string, bad_key int, item_id int")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in decontam.clean(frame, benchmark).collect()) == sorted(
        (i or 0, t) for i, t in docs[1:]
    )

    labels, docs = table(spark, SF, "labels"), table(spark, SF, "documents")
    bad = toxicity.score(docs, labels).filter("predicted = 1").join(docs, "doc_id").select("text").first()["text"]
    clean = toxicity.accepted(docs, labels).select("doc_id").first()["doc_id"]
    more = docs.unionByName(
        spark.createDataFrame([(clean, bad)], "doc_id long, text string"), allowMissingColumns=True
    )
    left = toxicity.accepted(more, labels).filter(F.col("doc_id") == clean).select("text").collect()
    assert len(left) == 1 and left[0]["text"] != bad


def test_line_dedup_leaves_other_columns(spark):
    line = "this line is in two of the documents"
    rows = [(1, line, 99, 7, "a", 1), (2, f"{line}\nown", 98, 8, "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, n_dropped int, `a.b` string, _n_lines int")
    found = corpus_pipeline.line_dedup(spark, docs, SF)
    assert found.columns == docs.columns
    assert sorted(map(tuple, found.collect())) == [rows[0], (2, "own", 98, 8, "b", 2)]


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries())
    assert numbers == list(range(1, 14)) and set(oracle_sql()) <= set(queries())
