"""Histories against golden tables and against slow, obvious simulations."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from listing_lake.operators import scd2

LOAD = "now"
D1, D2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
ROW = "property_id long, price long, is_current boolean, valid_from date, valid_to date"


def key(row):
    return tuple((v is None, v) for v in row)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


EXISTING = [(1, 100, True), (2, 200, True), (3, None, True), (None, 50, True), (1, 90, False),
            (4, 400, True), (5, 500, True)]
INCOMING = [(1, 110), (2, 200), (3, 300), (None, 50), (6, 600), (4, None), (5, 510), (5, 520)]
KEPT = [(None, 50, True), (1, 90, False), (2, 200, True), (3, None, True), (4, 400, True)]
NEW = [(None, 50, True), (1, 110, True), (3, 300, True), (4, None, True), (5, 510, True),
       (5, 520, True), (6, 600, True)]


def golden_frames(spark):
    gold = spark.createDataFrame([(*r, D1, None if r[2] else D1) for r in EXISTING], ROW)
    incoming = spark.createDataFrame([(*r, True, D2, None) for r in INCOMING], ROW)
    return gold, incoming


@pytest.mark.parametrize("copies,fives", [("per_match", 2), ("once", 1)])
def test_merge_golden(spark, copies, fives):
    gold, incoming = golden_frames(spark)
    merged = scd2.merge(gold, incoming, F.lit(D2), LOAD, copies=copies)
    expired = [(1, 100, False)] + [(5, 500, False)] * fives
    expected = sorted(KEPT + expired + NEW, key=key)
    assert rows(merged, "property_id", "price", "is_current") == expected
    ended = merged.filter(F.col("valid_to") == F.lit(D2))
    assert rows(ended, "property_id", "price", "is_current") == expired


def test_merge_rejects_unknown_mode(spark):
    gold, incoming = golden_frames(spark)
    with pytest.raises(ValueError):
        scd2.merge(gold, incoming, F.lit(D2), LOAD, copies="some")


def brute_merge(gold, incoming, day):
    """The three branches as nested loops."""
    out = []
    for g in gold:
        enders = [
            s for s in incoming
            if g[2] and None not in (g[0], g[1], s[0], s[1]) and g[0] == s[0] and g[1] != s[1]
        ]
        out += [(g[0], g[1], False, g[3], day)] * len(enders) if enders else [g]
    for s in incoming:
        known = any(
            g[2] and None not in (g[0], g[1], s[0], s[1]) and g[:2] == s for g in gold
        )
        if not known:
            out.append((*s, True, day, None))
    return out


def messy_batch(rng, ids, size):
    return [
        (rng.choice([*range(ids), None]), rng.choice([10, 20, 30, 40, None])) for _ in range(size)
    ]


def test_merge_against_nested_loops(spark, monkeypatch):
    # a small portion size unfolds hot ids in several portions
    monkeypatch.setattr(scd2, "PORTION", 3)
    rng = random.Random(7)
    gold = []
    for step in range(3):
        day = D1 + dt.timedelta(days=step)
        # one id owns a third of each batch
        batch = messy_batch(rng, 6, 20) + [(0, 10 * rng.randint(1, 9)) for _ in range(10)]
        incoming = spark.createDataFrame([(*r, True, day, None) for r in batch], ROW)
        before = spark.createDataFrame(gold, ROW)
        merged = scd2.merge(before, incoming, F.lit(day), LOAD, copies="per_match")
        gold = brute_merge(gold, batch, day)
        assert Counter(tuple(r) for r in merged.collect()) == Counter(gold)
        if step == 1:
            gold = random.Random(1).sample(gold, min(len(gold), 60))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("copies", ["per_match", "once"])
def test_replay_in_one_pass_equals_merge_after_merge(spark, copies, seed):
    """Batches of several files a day, repeats, NULLs, runs of one value, and a hot id."""
    rng = random.Random(seed)
    gold = [(i, p, True, D1, None) for i in range(9) for p in rng.sample([10, 20, 30, 40], rng.randint(0, 2))]
    gold += [(1, 10, True, D1, None), (None, 10, True, D1, None), (2, None, True, D1, None), (3, 99, False, D1, D1)]
    start, batches, files = list(gold), [], 14
    for file in range(files):
        day = D2 + dt.timedelta(days=file // 2)  # two files a day
        batch = messy_batch(rng, 9, rng.randint(0, 12)) + [(0, 10 * rng.randint(1, 3)) for _ in range(rng.randint(0, 3))]
        batches += [(*r, True, day, None, file) for r in batch]
        gold = brute_merge(gold, batch, day) if copies == "per_match" else once(gold, batch, day)
    incoming = spark.createDataFrame(batches, ROW + ", file int").repartition(3)
    found = scd2.replay(
        spark.createDataFrame(start, ROW), incoming, LOAD, copies=copies, steps=["valid_from", "file"]
    )
    assert Counter(tuple(r) for r in found.collect()) == Counter(gold)


def once(gold, batch, day):
    """The merge that keeps an ended version once."""
    merged = brute_merge(gold, batch, day)
    for g in gold:
        ended = (g[0], g[1], False, g[3], day)
        times = merged.count(ended)
        if g[2] and g not in merged and times:
            same = sum(o == g for o in gold)
            for _ in range(times - same):
                merged.remove(ended)
    return merged


def test_replay_of_nothing(spark):
    gold, incoming = golden_frames(spark)
    none = incoming.limit(0)
    assert rows(scd2.replay(gold, none, LOAD), "property_id", "price") == rows(gold, "property_id", "price")
    first = scd2.replay(gold.limit(0), incoming, LOAD)
    assert rows(first, "property_id", "price") == sorted(INCOMING, key=key)


def test_replay_has_a_fixed_number_of_exchanges(spark):
    gold, incoming = golden_frames(spark)
    plan = scd2.replay(gold, incoming, LOAD)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and plan.count("RepartitionByExpression") == 1


def test_timeline_golden(spark):
    data = [(1, 1, 100), (1, 2, None), (1, 3, 100), (1, 4, 100), (2, 1, None), (2, 2, 7)]
    df = spark.createDataFrame(
        [(i, dt.date(2025, 1, d), p) for i, d, p in data], "id long, day date, price long"
    )
    found = scd2.timeline(df, ["id"], "day", "price", ["price"])
    day = {n: dt.date(2025, 1, n) for n in range(1, 5)}
    assert rows(found, "id", "valid_from", "price", "valid_to", "is_current") == sorted([
        (1, day[1], 100, day[3], False), (1, day[3], 100, None, True),
        (2, day[1], None, day[2], False), (2, day[2], 7, None, True),
    ], key=key)


def brute_timeline(feed):
    """One row per id and day (lowest tie-break), changes, then ends."""
    out, ids = [], {r[0] for r in feed}
    for one in ids:
        per_day = {}
        for _, day, price, tie in sorted((r for r in feed if r[0] == one), key=lambda r: r[3]):
            per_day.setdefault(day, price)
        before, kept = None, []
        for day in sorted(per_day):
            price = per_day[day]
            if before is None or (price is not None and price != before):
                kept.append((day, price))
            before = price
        ends = [d for d, _ in kept[1:]] + [None]
        out += [(one, day, price, end, end is None) for (day, price), end in zip(kept, ends)]
    return out


def test_timeline_against_loop_with_a_hot_key(spark):
    rng = random.Random(3)
    feed = [
        (0 if rng.random() < 0.4 else rng.choice([*range(1, 15), None]),
         D1 + dt.timedelta(days=rng.randrange(20)), rng.choice([1, 2, 3, None]), tie)
        for tie in range(600)
    ]
    df = spark.createDataFrame(feed, "id long, day date, price long, tie long").repartition(5)
    found = scd2.timeline(df, ["id"], "day", "price", ["tie"])
    assert rows(found, "id", "valid_from", "price", "valid_to", "is_current") == sorted(
        brute_timeline(feed), key=key
    )


def clean_feed(rng, ids, days):
    """No NULLs, no repeats in a day, gaps allowed."""
    feed, price = [], {}
    for d in range(days):
        for i in range(ids):
            if rng.random() < 0.8:
                if rng.random() < 0.3 or i not in price:
                    price[i] = rng.randrange(100)
                feed.append((i, D1 + dt.timedelta(days=d), price[i]))
    return feed


def as_incoming(spark, feed, day):
    batch = [(i, p, True, d, None) for i, d, p in feed if d == day]
    return spark.createDataFrame(batch, ROW)


def test_replay_equals_bulk_on_a_clean_feed_and_repeats_change_nothing(spark):
    feed = clean_feed(random.Random(11), 12, 5)
    df = spark.createDataFrame(feed, "property_id long, day date, price long")
    bulk = scd2.timeline(df, ["property_id"], "day", "price", ["price"])
    columns = ("property_id", "price", "is_current", "valid_from", "valid_to")
    gold = []
    for day in sorted({d for _, d, _ in feed}):
        before = spark.createDataFrame(gold, ROW)
        gold = rows(
            scd2.merge(before, as_incoming(spark, feed, day), F.lit(day), LOAD), *columns
        )
    assert gold == rows(bulk, *columns)
    again = scd2.merge(
        spark.createDataFrame(gold, ROW), as_incoming(spark, feed, day), F.lit(day), LOAD
    )
    assert rows(again, *columns) == gold


def silver_rows(spark, data):
    """Silver-like rows from (id, day, price, city)."""
    df = spark.createDataFrame(data, "property_id long, snapshot_date date, price long, city string")
    texts = ["page_url", "url_hash", "property_type", "location", "province_name", "agency",
             "agent", "_ingested_at", "_bronze_run_id", "_transformed_at", "_silver_run_id"]
    numbers = ["location_id", "bedrooms", "baths", "latitude", "longitude", "area_marla", "price_per_marla"]
    return df.withColumns({
        **{c: F.lit("x") for c in texts}, **{c: F.lit(1) for c in numbers},
        "purpose": F.lit("For Sale"), "date_added": F.col("snapshot_date"),
    })


def test_late_rebuild_equals_a_full_rebuild(spark):
    rng = random.Random(5)
    days = [D1 + dt.timedelta(days=n) for n in range(6)]
    data = [(i, d, rng.randrange(3), rng.choice(["A", "B", None])) for i in range(10) for d in days]
    silver = silver_rows(spark, data)
    is_late = F.col("snapshot_date") == F.lit(days[2])
    gold = scd2.bulk_history(silver.filter(~is_late), LOAD)
    batch = scd2.incoming_versions(silver.filter(is_late), F.lit(days[2]), LOAD)
    late, on_time = scd2.split_late(batch, gold, ("table_name", "property_id"))
    assert late.count() + on_time.count() == 10
    assert on_time.filter("city IS NULL").count() == batch.filter("city IS NULL").count()
    rebuilt = scd2.rebuild_late(gold, silver, late, LOAD, ("table_name", "property_id"))
    affected = {r[0] for r in late.select("property_id").collect()}
    full = scd2.bulk_history(silver, LOAD)
    columns = ("property_id", "city", "price", "valid_from", "valid_to", "is_current")
    expected = rows(full.filter(F.col("property_id").isin(affected)), *columns) + rows(
        gold.filter(~F.col("property_id").isin(affected)), *columns
    )
    assert rows(rebuilt, *columns) == sorted(expected, key=key)


def test_rebuild_keeps_rows_without_a_city(spark):
    silver = silver_rows(spark, [(1, D1, 5, "A"), (1, D2, 6, "A")])
    gold = scd2.bulk_history(silver, LOAD)
    homeless = gold.withColumn("city", F.lit(None).cast("string"))
    late = gold.select("table_name", "property_id").distinct()
    rebuilt = scd2.rebuild_late(
        gold.unionByName(homeless), silver, late, LOAD, ("table_name", "property_id")
    )
    assert rows(rebuilt, "city", "price") == [("A", 5), ("A", 6), (None, 5), (None, 6)]


def test_as_of(spark):
    gold = spark.createDataFrame([(1, 1, False, D1, D2), (1, 2, True, D2, None)], ROW)
    assert rows(scd2.as_of(gold, F.lit(D1)), "price") == [(1,)]
    assert rows(scd2.as_of(gold, F.lit(D2)), "price") == [(2,)]
    assert rows(scd2.as_of(gold, F.lit(dt.date(2024, 1, 1))), "price") == []


def test_as_of_join_against_a_scan(spark):
    rng, days = random.Random(21), [D1 + dt.timedelta(days=n) for n in range(12)]
    feed = [(rng.choice([0, 0, 1, 2, None]), rng.choice(days), rng.choice([1, 2, 3]), n) for n in range(150)]
    df = spark.createDataFrame(feed, "id long, day date, price long, tie long")
    versions = scd2.timeline(df, ["id"], "day", "price", ["tie"]).filter("id IS NULL OR price != 3")
    # one id is asked for most of the time, also on equal days
    asked = [(n, rng.choice([0, 0, 0, 1, 2, 9, None]), rng.choice([*days, None])) for n in range(300)]
    frame = spark.createDataFrame(asked, "nth long, id long, at date")
    found = {r.nth: (r.price, r.valid_from, r.valid_to) for r in scd2.as_of_join(frame, versions, ["id"], "at", ["price"]).collect()}
    held = versions.collect()
    for nth, i, at in asked:
        fits = [
            (v.price, v.valid_from, v.valid_to)
            for v in held
            if None not in (i, at) and v.id == i and v.valid_from <= at and (v.valid_to is None or v.valid_to > at)
        ]
        assert found[nth] == (fits[0] if fits else (None, None, None)) and len(fits) < 2
    assert len(found) == len(asked)
