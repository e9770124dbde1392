"""The keyed-state stream against merges one after another."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from listing_lake.operators import scd2
from listing_lake.session import stored, work_dir
from listing_lake.streaming import history
from tests.test_scd2 import D1, LOAD, messy_batch, silver_rows

COLUMNS = ("property_id", "price", "is_current", "valid_from", "valid_to")


def found(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def silver_of(spark, rows, file_hash):
    frame = silver_rows(spark, [(i, day, price, "A") for i, day, price in rows])
    return frame.withColumn("file_hash", F.lit(file_hash)).withColumns(
        {c: F.col(c).cast("double") for c in ("latitude", "longitude", "area_marla", "price_per_marla")}
    )


@pytest.mark.parametrize("copies", [scd2.ONCE, scd2.PER_MATCH])
def test_stream_equals_merges_over_runs_and_restarts(spark, copies):
    rng, days = random.Random(13), [D1 + dt.timedelta(days=n) for n in range(7)]
    batches = [
        [(i, day, p) for i, p in messy_batch(rng, 6, 14)] + [(0, day, 10 * rng.randint(1, 3))] for day in days
    ]
    files = [stored(silver_of(spark, rows, f"hash-{n}")) for n, rows in enumerate(batches)]
    gold = stored(scd2.bulk_history(files[0], LOAD, scd2.MERGE_KEYS))
    place = work_dir(spark, "stream")

    def run():
        history.stream_versions(spark, f"{place}/silver", f"{place}/events", f"{place}/position", gold)

    for part in ((1, 2), (3,), (), (4, 5, 6)):  # a run without files changes nothing
        for n in part:
            files[n].write.mode("append").parquet(f"{place}/silver")
        if part or n:
            run()
    want = gold
    for n, day in enumerate(days[1:], start=1):
        incoming = scd2.incoming_versions(files[n], F.lit(day), LOAD)
        want = stored(scd2.merge(want, incoming, F.lit(day), LOAD, history.IDS, copies=copies))
    events = spark.read.schema(history.EVENTS).parquet(f"{place}/events")
    silver = files[1]
    for more in files[2:]:
        silver = silver.unionByName(more)
    assert found(history.history(gold, silver, events, LOAD, copies)) == found(want)


def test_equal_rows_are_counted_before_the_shuffle():
    import pyarrow as pa

    rows = pa.table({"table_name": ["a"] * 5, "property_id": [1, 1, 1, 2, 1], "n": [1, 1, 1, 1, 2]})
    (batch,) = history._counted(rows.to_batches())
    assert sorted(map(tuple, (r.values() for r in batch.to_pylist()))) == [("a", 1, 5), ("a", 2, 1)]


def test_only_ids_that_a_batch_brings_get_a_state_and_a_call(spark):
    old = silver_of(spark, [(i, D1, 100) for i in range(50)], "hash-0")
    gold = stored(scd2.bulk_history(old, LOAD, scd2.MERGE_KEYS))
    place, later = work_dir(spark, "stream"), [D1 + dt.timedelta(days=n) for n in (1, 2)]
    brought = ([(0, later[0], 100), (1, later[0], 200)], [(2, later[1], 300), (1, later[1], 100)])
    kept = []
    for n, rows in enumerate(brought):
        silver_of(spark, rows, f"hash-{n + 1}").write.mode("append").parquet(f"{place}/silver")
        # what was there before the first run is known from then on
        known = gold if n == 0 else None
        query = history.stream_versions(spark, f"{place}/silver", f"{place}/events", f"{place}/position", known)
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert kept == [1, 2]  # id 0 came back with its open value
    events = spark.read.schema(history.EVENTS).parquet(f"{place}/events")
    ended = events.filter("event = 'ended'").select("property_id", "price", "nth", "day")
    assert sorted(map(tuple, ended.collect())) == [(1, 100, 0, later[0]), (1, 200, 1, later[1]), (2, 100, 0, later[1])]
