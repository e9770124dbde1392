"""Runs over real folders: idempotence, quarantine, modes, versions, rollback."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from listing_lake import rules, schemas
from listing_lake.operators import scd2
from listing_lake.plans import pipeline
from listing_lake.sources.lake import Lake
from listing_lake.streaming import streams

HEADER = ",".join(schemas.RAW_COLUMNS)


def line(pid, price, purpose="For Sale", city="Lahore"):
    return (f"{pid},7,https://x/{pid},House,{price},Block A,{city},Punjab,31.5,74.3,2,3,"
            f"{purpose},2025-03-01,Agency,Agent,Marla,5")


def put(lake, name, *lines, header=HEADER):
    with open(f"{lake.landing}/{name}", "w") as out:
        out.write("\n".join([header, *lines]) + "\n")


def run_all(lake, now, **options):
    pipeline.bronze_ingest(lake, "run", now)
    pipeline.silver_transform(lake, "run", now)
    return pipeline.gold_publish(lake, "run", now, **options)


def statuses(lake):
    return {
        (r["file_name"].split("_")[0].split(".")[0], r["layer"]): (r["status"], r["retry_count"], r["row_count"])
        for r in lake.lineage.read().collect()
    }


def versions(lake, table="gold_sales"):
    found = lake.gold.read(table).select("property_id", "price", "valid_from", "valid_to", "is_current")
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0], r[2], r[1]))


def day(n):
    return dt.date(2025, 3, n)


def test_daily_life(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000), line(2, 300000), line(3, 5000, "For Rent"))
    put(lake, "b_2025-03-02.csv", line(1, 250000), line(2, 300000))
    assert run_all(lake, now) == "bulk"
    assert versions(lake) == [
        (1, 200000, day(1), day(2), False), (1, 250000, day(2), None, True),
        (2, 300000, day(1), None, True),
    ]
    assert versions(lake, "gold_rentals") == [(3, 5000, day(1), None, True)]
    head = lake.gold.latest()["gold_sales"]

    # nothing new: nothing happens
    assert run_all(lake, now) is None
    assert lake.gold.latest()["gold_sales"] == head

    put(lake, "c_2025-03-03.csv", line(1, 260000), line(9, 1000))
    assert run_all(lake, now) == "merge"
    assert versions(lake)[-1] == (9, 1000, day(3), None, True)
    assert (1, 250000, day(2), day(3), False) in versions(lake)
    pipeline.export_history(lake, "gold_sales", f"{lake.root}/export")
    exported = lake.spark.read.option("header", True).csv(f"{lake.root}/export")
    assert [r["property_id"] for r in exported.collect()] == ["1", "1", "1"]
    # time travel, then back
    assert lake.gold.read("gold_sales", version=1).count() == 3
    lake.gold.restore(1, now)
    assert lake.gold.read("gold_sales").count() == 3
    assert lake.gold.snapshots(1).count() == 2
    assert {s for s, *_ in statuses(lake).values()} == {"SUCCESS"}
    assert lake.gold.read("gold_sales").columns == schemas.GOLD.names


def test_equal_content_counts_once_and_equal_names_do_not_collide(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000))
    put(lake, "copy_2025-03-01.csv", line(1, 200000))
    pipeline.bronze_ingest(lake, "run", now)
    assert lake.bronze().count() == 1
    put(lake, "a_2025-03-01.csv", line(2, 300000))
    pipeline.bronze_ingest(lake, "run", now)
    assert lake.bronze().count() == 2
    assert lake.lineage.read().count() == 2


def test_bad_files_and_records(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000), "7,too,short")
    put(lake, "010.jpg.csv", line(4, 1))
    put(lake, "empty_2025-03-01.csv")
    pipeline.bronze_ingest(lake, "run", now)
    assert lake.bronze().count() == 1
    rejected = {r["raw_record"].split("/")[-1]: r["error"] for r in lake.quarantine().collect()}
    assert rejected == {
        "7,too,short": "record does not fit the header", "010.jpg.csv": "unexpected file name",
    }
    assert statuses(lake) == {
        ("a", "BRONZE"): ("SUCCESS", 0, 1), ("010", "BRONZE"): ("FAILED", 0, None),
        ("empty", "BRONZE"): ("SUCCESS", 0, 0),
    }
    for _ in range(4):
        pipeline.bronze_ingest(lake, "run", now)
    assert statuses(lake)["010", "BRONZE"][:2] == ("FAILED", 4)  # no limit unless one is set
    aside = Lake(lake.spark, lake.root, max_retries=3)
    pipeline.bronze_ingest(aside, "run", now)
    pipeline.bronze_ingest(aside, "run", now)
    assert statuses(lake)["010", "BRONZE"][:2] == ("QUARANTINED", 5)
    spoiled = lake.lineage.read().filter("status = 'QUARANTINED'").first()["file_hash"]
    aside.lineage.release(spoiled, now)
    assert statuses(lake)["010", "BRONZE"][:2] == ("FAILED", 0)
    put(lake, "bad_2025-03-01.csv", "7,too,short", "8,too,short")
    pipeline.bronze_ingest(lake, "run", now)
    assert statuses(lake)["bad", "BRONZE"] == ("FAILED", 0, 0)
    told = lake.lineage.read().filter("error_message LIKE '%records rejected'").collect()
    assert sorted(r["error_message"] for r in told) == ["1 of 2 records rejected", "2 of 2 records rejected"]
    pipeline.silver_transform(lake, "run", now)
    assert statuses(lake)["empty", "SILVER"] == ("SUCCESS", 0, 0)
    assert lake.silver().columns == [*schemas.SILVER.names, "snapshot_date", "file_hash"]


def test_extra_columns_stay_readable(lake, now):
    assert lake.bronze_as_landed().columns == lake.bronze().columns
    put(lake, "a_2025-03-01.csv", line(1, 200000))
    put(lake, "b_2025-03-02.csv", line(2, 300000) + ",north", header=HEADER + ",wing")
    pipeline.bronze_ingest(lake, "run", now)
    found = {r["property_id"]: r["wing"] for r in lake.bronze_as_landed().collect()}
    assert found == {"1": None, "2": "north"} and "wing" not in lake.bronze().columns


def test_batch_limits(lake, now, monkeypatch):
    for n in range(3):
        put(lake, f"f{n}_2025-03-0{n + 1}.csv", line(n, 200000))
    for expected in (1, 2, 3, 3):
        pipeline.bronze_ingest(lake, "run", now, batch_limit=1)
        assert lake.bronze().count() == expected
    assert lake.seen().count() == 3  # known files are not read again
    for expected in (1, 2, 3):
        pipeline.silver_transform(lake, "run", now, batch_limit=1)
        assert lake.silver().count() == expected


def test_undated_files(lake, now):
    put(lake, "a.csv", line(1, 200000))
    put(lake, "b_2025-03-02.csv", line(2, 300000))
    run_all(lake, now)
    assert statuses(lake)["a", "GOLD"][0] == "FAILED"
    assert [v[0] for v in versions(lake)] == [2]
    # in merge mode an undated file counts as today's
    assert run_all(lake, now) == "merge"
    assert (1, 200000, now.date(), None, True) in versions(lake)


def test_late_files(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000), line(2, 5))
    put(lake, "b_2025-03-05.csv", line(1, 250000))
    run_all(lake, now)
    put(lake, "c_2025-03-03.csv", line(1, 220000), line(8, 9))
    run_all(lake, now, late="rebuild")
    assert [v[1:] for v in versions(lake) if v[0] == 1] == [
        (200000, day(1), day(3), False), (220000, day(3), day(5), False),
        (250000, day(5), None, True),
    ]
    assert (8, 9, day(3), None, True) in versions(lake) and (2, 5, day(1), None, True) in versions(lake)


def test_a_run_that_died_before_its_lineage_is_not_repeated(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000))
    run_all(lake, now)
    lake.lineage.delete_layer(rules.GOLD, now)
    assert pipeline.gold_publish(lake, "run", now) is None
    assert statuses(lake)["a", "GOLD"][0] == "SUCCESS"
    assert len(versions(lake)) == 1


def test_a_lost_silver_file_stays_waiting(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000))
    put(lake, "b_2025-03-02.csv", line(2, 300000))
    pipeline.bronze_ingest(lake, "run", now)
    pipeline.silver_transform(lake, "run", now)
    lost = lake.lineage.read().filter("layer = 'SILVER' AND file_name LIKE 'b_%'").first()["file_hash"]
    shutil.rmtree(f"{lake.silver_dir}/snapshot_date=2025-03-02/file_hash={lost}")
    assert pipeline.gold_publish(lake, "run", now) == "bulk"
    assert ("b", "GOLD") not in statuses(lake) and [v[0] for v in versions(lake)] == [1]
    lake.lineage._update(lambda old: old.filter(f"file_hash <> '{lost}' OR layer <> 'SILVER'"), now)
    run_all(lake, now)
    assert statuses(lake)["b", "GOLD"][0] == "SUCCESS" and [v[0] for v in versions(lake)] == [1, 2]


def test_one_bad_file_fails_alone_in_silver(lake, now, monkeypatch):
    put(lake, "a_2025-03-01.csv", line(1, 200000))
    put(lake, "b_2025-03-02.csv", line(2, 300000))
    pipeline.bronze_ingest(lake, "run", now)
    real = pipeline._write_silver

    def fragile(lake, files, *rest):
        if not files.filter("file_name LIKE 'b_%'").isEmpty():
            raise RuntimeError("unreadable")
        real(lake, files, *rest)

    monkeypatch.setattr(pipeline, "_write_silver", fragile)
    pipeline.silver_transform(lake, "run", now)
    assert statuses(lake)["a", "SILVER"] == ("SUCCESS", 0, 1)
    assert statuses(lake)["b", "SILVER"] == ("FAILED", 0, None)
    monkeypatch.undo()
    pipeline.silver_transform(lake, "run", now)
    assert statuses(lake)["b", "SILVER"][0] == "SUCCESS"


def test_a_rebuild_without_all_silver_is_refused(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000))
    put(lake, "b_2025-03-05.csv", line(1, 250000))
    run_all(lake, now)
    before = versions(lake)
    shutil.rmtree(f"{lake.silver_dir}/snapshot_date=2025-03-01")
    put(lake, "c_2025-03-03.csv", line(1, 220000))
    with pytest.raises(ValueError, match="Silver lacks"):
        run_all(lake, now, late="rebuild")
    assert versions(lake) == before and statuses(lake)["c", "GOLD"][0] == "FAILED"


def test_files_are_merged_by_date_then_name(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 100000))
    run_all(lake, now)
    put(lake, "z_2025-03-02.csv", line(1, 200000))
    put(lake, "b_2025-03-03.csv", line(1, 300000))
    run_all(lake, now)
    assert [v[1:3] for v in versions(lake)] == [(100000, day(1)), (200000, day(2)), (300000, day(3))]


def test_a_rolled_back_stream_loads_again(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000), "7,too,short")
    for _ in range(2):
        streams.stream_bronze(lake, "run", now)
        streams.stream_silver(lake, "run", now)
        streams.stream_gold(lake, lake.silver_dir, now)
        assert lake.bronze().count() == lake.silver().count() == 1
        assert versions(lake) == [(1, 200000, day(1), None, True)]
        assert statuses(lake)["a", "SILVER"] == ("SUCCESS", 0, 1)
        for layer in (rules.GOLD, rules.SILVER, rules.BRONZE):
            pipeline.rollback_layer(lake, layer, now)


def test_streamed_late_file_rebuilds_without_loss(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000), line(2, 5))
    put(lake, "b_2025-03-05.csv", line(1, 250000))
    for name in (None, "c_2025-03-03.csv"):
        if name:
            put(lake, name, line(1, 220000))
        streams.stream_bronze(lake, "run", now)
        streams.stream_silver(lake, "run", now)
        streams.stream_gold(lake, lake.silver_dir, now, late="rebuild")
    assert [v[:2] for v in versions(lake)] == [(1, 200000), (1, 220000), (1, 250000), (2, 5)]


def test_compaction_expiry_and_conflicts(lake, now, monkeypatch):
    for n in (1, 2, 3):
        put(lake, f"f_2025-03-0{n}.csv", line(1, 100000 * n))
        run_all(lake, now)
    before = versions(lake)
    assert len(lake.gold.latest()["gold_sales"]["closed_versions"]) == 3
    lake.gold.compact(now)
    assert len(lake.gold.latest()["gold_sales"]["closed_versions"]) == 1
    assert versions(lake) == before
    assert lake.gold.expire(keep=1) == [1, 2, 3]
    assert versions(lake) == before and run_all(lake, now) is None
    lake.lineage.expire(keep=1)
    assert len(statuses(lake)) > 0
    put(lake, "f_2025-03-04.csv", line(1, 900000))
    assert run_all(lake, now) == "merge" and versions(lake)[-1][1] == 900000
    newest = lake.gold.latest()
    monkeypatch.setattr(lake.gold, "latest", lambda version=None: {t: {**r.asDict(), "version": r["version"] - 1} for t, r in newest.items()})
    with pytest.raises(RuntimeError, match="another writer"):
        lake.gold.reset(now)


def test_a_failed_merge_is_recorded(lake, now, monkeypatch):
    put(lake, "a_2025-03-01.csv", line(1, 200000))
    run_all(lake, now)
    put(lake, "b_2025-03-02.csv", line(1, 210000))

    def broken(*_args, **_options):
        raise RuntimeError("disk full")

    monkeypatch.setattr(pipeline, "merge_batch", broken)
    monkeypatch.setattr(pipeline, "merge_batches", broken)
    with pytest.raises(RuntimeError):
        run_all(lake, now)
    assert statuses(lake)["b", "GOLD"][0] == "FAILED"
    monkeypatch.undo()
    assert run_all(lake, now) == "merge"
    assert len(versions(lake)) == 2


def test_rollback_and_reload(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000))
    run_all(lake, now)
    before = versions(lake)
    pipeline.rollback_layer(lake, rules.GOLD, now)
    assert lake.gold.is_empty() and versions(lake) == []
    pipeline.rollback_layer(lake, rules.SILVER, now)
    assert lake.silver().isEmpty()
    pipeline.rollback_layer(lake, rules.BRONZE, now)
    assert lake.bronze().isEmpty() and lake.lineage.read().isEmpty()
    assert run_all(lake, now) == "bulk"
    assert versions(lake) == before
    with pytest.raises(ValueError):
        pipeline.rollback_layer(lake, "TIN", now)


def test_streams_equal_batch(lake, now, tmp_path, spark):
    put(lake, "a_2025-03-01.csv", line(1, 200000), line(3, 5000, "For Rent"))
    put(lake, "b_2025-03-02.csv", line(1, 250000))
    streams.stream_bronze(lake, "run", now)
    streams.stream_bronze(lake, "run", now)
    assert lake.bronze().count() == 3
    pipeline.silver_transform(lake, "run", now)
    streams.stream_gold(lake, lake.silver_dir, now)
    once = versions(lake)
    streams.stream_gold(lake, lake.silver_dir, now)
    assert versions(lake) == once == [
        (1, 200000, day(1), day(2), False), (1, 250000, day(2), None, True),
    ]
    put(lake, "c_2025-03-03.csv", line(1, 260000))
    streams.stream_bronze(lake, "run", now)
    pipeline.silver_transform(lake, "run", now)
    streams.stream_gold(lake, lake.silver_dir, now)
    assert versions(lake)[-1] == (1, 260000, day(3), None, True)


def test_a_city_read_touches_its_folders_only(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000), line(2, 1, city="Karachi"))
    run_all(lake, now)
    one = lake.gold.read("gold_sales").filter((F.col("city") == "Lahore") & F.col("is_current"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "Lahore" in filters and "gold_sales" in filters and "is_current" in filters
    assert scd2.current_rows(lake.gold.read()).count() == 2


def test_rows_that_break_an_expectation_are_not_published(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000))
    run_all(lake, now)
    before = versions(lake)
    bad = lake.gold.read().withColumn("valid_to", F.lit(day(2)))  # open, yet ended
    with pytest.raises(ValueError, match="open_versions_have_no_end"):
        pipeline._publish(lake, bad, pipeline.MERGE, now, keeps_closed=True)
    assert versions(lake) == before and lake.gold.log().agg(F.max("version")).first()[0] == 1


def test_views_over_the_lake(lake, now):
    put(lake, "a_2025-03-01.csv", line(1, 200000))
    run_all(lake, now)
    assert "mine_gold_sales" in lake.register_views("mine")
    found = lake.spark.sql("SELECT s.price FROM mine_gold_sales g JOIN mine_silver s ON g.property_id = s.property_id")
    assert [r.price for r in found.collect()] == [200000]
    assert lake.spark.sql("SELECT * FROM mine_lineage").count() == 3
