"""Lineage upsert against a row-by-row simulation, and the stored table."""

import datetime as dt
import random

from pyspark.sql import functions as F

from listing_lake import rules, schemas
from listing_lake.operators import lineage as ops
from listing_lake.sources.lineage_table import LineageTable

AT = dt.datetime(2025, 1, 1)
LATER = dt.datetime(2025, 2, 1)


def outcome(file_hash, status, seq, layer="BRONZE", name="n", rows=1):
    return (file_hash, layer, f"{name}{seq}", "run", status, rows, rows, None, seq)


def apply(spark, lineage, records, at=AT):
    batch = spark.createDataFrame(records, schemas.OUTCOME)
    return ops.upsert(lineage, batch, F.lit(at).cast("timestamp"))


def empty(spark):
    return spark.createDataFrame([], schemas.LINEAGE)


def test_retry_count_of_one_key(spark):
    lineage = empty(spark)
    counts = []
    for seq, status in enumerate(["FAILED", "FAILED", "SUCCESS", "FAILED"]):
        lineage = apply(spark, lineage, [outcome("h", status, seq)])
        counts.append(lineage.first()["retry_count"])
    assert counts == [0, 1, 1, 2]
    at_once = apply(
        spark, empty(spark),
        [outcome("h", s, i) for i, s in enumerate(["FAILED", "FAILED", "SUCCESS", "FAILED"])],
    ).first()
    assert (at_once["retry_count"], at_once["status"], at_once["file_name"]) == (2, "FAILED", "n3")


def simulate(state, records):
    for file_hash, layer, name, _, status, rows, *_rest in records:
        old = state.get((file_hash, layer))
        retries = 0 if old is None else old[2] + (status == "FAILED")
        state[file_hash, layer] = (name, status, retries, rows)
    return state


def test_upsert_against_simulation(spark):
    rng = random.Random(4)
    state, lineage, seq = {}, empty(spark), 0
    for _ in range(3):
        records = []
        for _ in range(40):
            # one file gets a third of all records
            file_hash = "hot" if rng.random() < 0.33 else f"h{rng.randrange(9)}"
            records.append(outcome(file_hash, rng.choice(["SUCCESS", "FAILED"]), seq,
                                   rng.choice(["BRONZE", "SILVER"]), rows=rng.randrange(9)))
            seq += 1
        lineage = apply(spark, lineage, rng.sample(records, len(records)))
        state = simulate(state, records)
    found = {
        (r["file_hash"], r["layer"]): (r["file_name"], r["status"], r["retry_count"], r["row_count"])
        for r in lineage.collect()
    }
    assert found == state


def test_times_and_untouched_keys(spark):
    lineage = apply(spark, empty(spark), [outcome("a", "SUCCESS", 0), outcome("b", "SUCCESS", 1)])
    lineage = apply(spark, lineage, [outcome("a", "SUCCESS", 2, rows=7)], LATER)
    found = {r["file_hash"]: r for r in lineage.collect()}
    assert (found["a"]["created_at"], found["a"]["updated_at"]) == (AT, LATER)
    assert (found["b"]["created_at"], found["b"]["updated_at"]) == (AT, AT)
    assert (found["a"]["row_count"], found["b"]["row_count"]) == (7, 1)
    assert lineage.dtypes == empty(spark).dtypes


def test_selection(spark):
    lineage = apply(spark, empty(spark), [
        outcome("a", "SUCCESS", 0), outcome("b", "SUCCESS", 1), outcome("c", "FAILED", 2),
        outcome("d", "SUCCESS", 3), outcome("a", "SUCCESS", 4, "SILVER"),
        outcome("d", "QUARANTINED", 5, "SILVER"), outcome("b", "FAILED", 6, "SILVER"),
    ])
    waiting = ops.eligible(lineage, rules.SILVER, rules.BRONZE)
    assert {r["file_hash"] for r in waiting.collect()} == {"b"}
    assert ops.first_files(lineage, 0, "file_name").count() == 7
    assert [r["file_name"] for r in ops.first_files(lineage, 2, "file_name").collect()] == ["n0", "n1"]
    assert ops.delete_layer(lineage, rules.SILVER).count() == 4


def test_files_out_of_retries_are_set_aside(spark):
    records = [outcome("a", "FAILED", i) for i in range(4)] + [outcome("b", "FAILED", 9)]
    status = {r["file_hash"]: r["status"] for r in ops.set_aside(apply(spark, empty(spark), records), 3).collect()}
    assert status == {"a": "QUARANTINED", "b": "FAILED"}


def test_stored_table(spark, tmp_path, now):
    table = LineageTable(spark, str(tmp_path / "lineage"))
    assert table.read().isEmpty()
    records = [outcome("a", "SUCCESS", 0), outcome("a", "SUCCESS", 1, "SILVER")]
    table.record(spark.createDataFrame(records, schemas.OUTCOME), now)
    table.delete_layer("SILVER", now)
    assert [r["layer"] for r in table.read().collect()] == ["BRONZE"]
    table.truncate(now)
    assert table.read().isEmpty() and table.version() == 3


def test_no_limit_on_retries_and_release(spark):
    records = [outcome("a", "FAILED", i) for i in range(9)]
    table = apply(spark, empty(spark), records)
    assert ops.set_aside(table, None).first()["status"] == "FAILED"
    aside = ops.set_aside(table, 3)
    assert aside.first()["status"] == "QUARANTINED"
    at = F.lit("2025-06-02 00:00:00").cast("timestamp")
    for name, expected in (("other", ("QUARANTINED", 8)), ("a", ("FAILED", 0))):
        row = ops.release(aside, name, at).first()
        assert (row["status"], row["retry_count"]) == expected
    assert ops.release(aside, "a", at).schema == aside.schema
