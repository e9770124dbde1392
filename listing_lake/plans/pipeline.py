"""The three batch runs and the layer rollback.

Each run reads the lineage once, handles all its files in one Spark job per
step, and records all outcomes in one upsert at the end. Data is committed
before its lineage, and every write replaces exactly what it wrote before, so a
run that died can simply be started again.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_lake import rules, schemas
from listing_lake.functions import naming
from listing_lake.operators import lineage as ops
from listing_lake.operators import quality, scd2
from listing_lake.operators.silver import silver_clean
from listing_lake.session import stored
from listing_lake.sources import landing
from listing_lake.sources.lake import Lake

_log = logging.getLogger(__name__)

BULK, MERGE, REBUILD = "bulk", "merge", "rebuild"


def _outcomes(files: DataFrame, layer: str, run_id: str | None) -> DataFrame:
    """Outcome records; columns a step does not know stay NULL."""
    known = {
        "layer": F.lit(layer),
        "run_id": F.lit(run_id),
        "seq": F.lit(1),
    }
    return files.select(
        *[
            known.get(
                f.name, F.col(f.name) if f.name in files.columns else F.lit(None)
            ).cast(f.dataType).alias(f.name)
            for f in schemas.OUTCOME
        ]
    )


# ------------------------------------------------------------------ Bronze


def bronze_ingest(
    lake: Lake, run_id: str | None, now: dt.datetime, batch_limit: int = 0
) -> None:
    """Take in landing files whose content is new, at most ``batch_limit`` (0: all).

    A file whose path, length and time are those it had when it was taken in is
    known without reading it, so it neither costs a read nor uses up the limit.
    Landing files are never deleted.
    """
    listed = landing.list_files(lake.spark, lake.landing)
    handled = ops.in_state(lake.lineage.read(), rules.BRONZE, rules.SUCCESS, rules.QUARANTINED)
    known = lake.seen().join(handled, "file_hash", "left_semi").select("path", "length", "modified")
    files = listed.join(known, ["path", "length", "modified"], "left_anti").select(*listed.columns)
    files = ops.first_files(files, batch_limit, "file_name", "path")
    # a limit leaves one partition; hashing is per file and heavy
    tasks = int(lake.spark.conf.get("spark.sql.shuffle.partitions"))
    ingest_files(lake, files.repartition(tasks), run_id, now)


def ingest_files(
    lake: Lake, files: DataFrame, run_id: str | None, now: dt.datetime
) -> None:
    """Hash, read, stamp and store landing files; bad records go to quarantine.

    A file all of whose records are rejected has failed.
    """
    prints = stored(
        landing.fingerprints(files).withColumns(
            {
                "error": naming.error_text(
                    F.coalesce(
                        "error",
                        F.when(~naming.is_landing_name(F.col("file_name")), "unexpected file name"),
                    )
                ),
                "file_hash": F.coalesce(
                    "file_hash", F.concat(F.lit("nohash:"), F.sha2("path", 256))
                ),
            }
        )
    )
    # equal files in one batch count once; hashing is not repeated downstream
    first = prints.groupBy("file_hash").agg(
        F.min_by(F.struct(*[c for c in prints.columns if c != "file_hash"]), "file_name").alias("f")
    )
    todo = stored(
        ops.unprocessed(first.select("file_hash", "f.*"), lake.lineage.read(), rules.BRONZE)
    )
    if todo.isEmpty():
        lake.remember(prints)
        return
    good, bad = todo.filter("error IS NULL"), todo.filter("error IS NOT NULL")

    rows = landing.read_rows(lake.spark, good)
    corrupt = F.col(landing.CORRUPT)
    rejected = bad.select(
        "file_hash", "error", "file_name", F.col("path").alias("raw_record")
    ).withColumn("quarantined", F.lit(True))
    stamped = (
        rows.withColumns(
            {
                "raw_record": corrupt,
                "error": F.when(corrupt.isNotNull(), F.lit("record does not fit the header")),
                "quarantined": corrupt.isNotNull(),
            }
        )
        .drop(landing.CORRUPT)
        .unionByName(rejected, allowMissingColumns=True)
        .withColumnRenamed("file_name", "_source_file")
        .withColumns(
            {
                "_ingested_at": F.lit(now.isoformat()),
                "_run_id": F.lit(run_id).cast("string"),
            }
        )
    )
    lake.write_bronze(stamped)

    refused = lake.quarantine(good).groupBy("file_hash").agg(F.count(F.lit(1)).alias("_refused"))
    read = (
        good.drop("error")
        .join(lake.bronze_facts(good), "file_hash", "left")
        .join(refused, "file_hash", "left")
        .withColumn("row_count", F.coalesce("row_count", F.lit(0)))
        .withColumn("status", F.when((F.col("_refused") > 0) & (F.col("row_count") == 0), rules.FAILED).otherwise(rules.SUCCESS))
        .withColumn(
            "error_message",
            F.when(
                F.col("_refused") > 0,
                F.format_string("%d of %d records rejected", "_refused", F.col("_refused") + F.col("row_count")),
            ),
        )
    )
    failed = bad.withColumn("status", F.lit(rules.FAILED)).withColumnRenamed(
        "error", "error_message"
    )
    lake.lineage.record(
        _outcomes(
            read.withColumn("file_name", naming.bronze_name(F.col("file_name"))),
            rules.BRONZE,
            run_id,
        ).unionByName(_outcomes(failed, rules.BRONZE, run_id)),
        now,
    )
    lake.remember(prints)


# ------------------------------------------------------------------ Silver


def silver_transform(
    lake: Lake, run_id: str | None, now: dt.datetime, batch_limit: int = 0
) -> None:
    """Clean every Bronze file that has not been cleaned yet, all in one job.

    If the job fails, its files are tried one by one, so that only those that
    fail themselves are recorded as failed. Files whose Bronze data is gone get
    no outcome and do not use up the limit.
    """
    waiting = ops.eligible(lake.lineage.read(), rules.SILVER, rules.BRONZE)
    held = lake.bronze(waiting).select("file_hash").distinct()
    present = waiting.join(held, "file_hash", "left_semi").unionByName(
        waiting.join(held, "file_hash", "left_anti").filter("row_count = 0")
    )
    files = stored(ops.first_files(present, batch_limit, "file_name", "file_hash"))
    if not files.isEmpty():
        clean_files(lake, files, run_id, now)


def clean_files(lake: Lake, files: DataFrame, run_id: str | None, now: dt.datetime) -> None:
    """Clean whole Bronze files (file_hash, file_name, row_count) and record the outcomes."""
    done, failed = files, None
    try:
        _write_silver(lake, files, run_id, now)
    except Exception:
        errors = []
        for file in files.select("file_hash").toLocalIterator():
            try:
                _write_silver(lake, files.filter(F.col("file_hash") == file["file_hash"]), run_id, now)
            except Exception as failure:
                errors.append((file["file_hash"], str(failure)))
        found = lake.spark.createDataFrame(errors, "file_hash string, error_message string")
        failed = files.join(found, "file_hash").drop("row_count").withColumns(
            {"status": F.lit(rules.FAILED), "error_message": naming.error_text(F.col("error_message"))}
        )
        done = files.join(found, "file_hash", "left_anti")
    outcomes = _outcomes(
        done.drop("row_count")
        .join(lake.silver_facts(done), "file_hash", "left")
        .withColumns(
            {
                "row_count": F.coalesce("row_count", F.lit(0)),
                "file_name": naming.silver_name(F.col("file_name")),
                "status": F.lit(rules.SUCCESS),
            }
        ),
        rules.SILVER,
        run_id,
    )
    if failed is not None:
        outcomes = outcomes.unionByName(_outcomes(failed, rules.SILVER, run_id))
    lake.lineage.record(outcomes, now)


def _write_silver(lake: Lake, files: DataFrame, run_id: str | None, now: dt.datetime) -> None:
    bronze = lake.bronze(files).withColumn(
        "snapshot_date", naming.snapshot_date(F.col("_source_file"))
    )
    lake.write_silver(
        silver_clean(bronze, run_id, now.isoformat(), carry=("snapshot_date", "file_hash"))
    )


# ------------------------------------------------------------------ Gold


def select_mode(lake: Lake) -> str:
    """Bulk while both Gold tables are empty, merge afterwards."""
    return BULK if lake.gold.is_empty() else MERGE


def gold_publish(
    lake: Lake,
    run_id: str | None,
    now: dt.datetime,
    late: str = MERGE,
    copies: str = scd2.ONCE,
) -> str | None:
    """Bring all waiting Silver files into Gold; returns the mode used.

    ``late`` says what to do with files older than versions already stored:
    ``merge`` applies them like any other file, ``rebuild`` recomputes the
    history of the ids they touch. ``copies``: see ``merge_open``. Files whose
    Silver data is missing get no outcome and stay waiting.
    """
    lake.gold.create_if_missing(now)
    in_gold = lake.gold.committed_files().withColumn("in_gold", F.lit(True))
    ready = ops.eligible(lake.lineage.read(), rules.GOLD, rules.SILVER)
    held = lake.silver(ready).select("file_hash").distinct().withColumn("held", F.lit(True))
    waiting = stored(
        ready.join(in_gold, "file_hash", "left")
        .join(held, "file_hash", "left")
        .filter("held OR in_gold OR row_count = 0")
        .withColumn("snapshot_date", naming.snapshot_date(F.col("file_name")))
    )
    # files an earlier run committed without getting to the lineage
    known = waiting.filter("in_gold")
    if not known.isEmpty():
        lake.lineage.record(_gold_outcomes(known, rules.SUCCESS, run_id), now)
    files = waiting.filter("in_gold IS NULL")
    if files.isEmpty():
        return None
    mode = select_mode(lake)
    if mode == BULK:
        _publish_bulk(lake, files, run_id, now)
    else:
        _publish_in_order(lake, files, run_id, now, late, copies)
    return mode


def _gold_outcomes(files: DataFrame, status: str, run_id: str | None, error: str | None = None):
    return _outcomes(
        files.select("file_hash", "file_name").withColumns(
            {
                "status": F.lit(status),
                "error_message": naming.error_text(F.lit(error).cast("string")),
            }
        ),
        rules.GOLD,
        run_id,
    )


def _publish_bulk(lake: Lake, files: DataFrame, run_id: str | None, now: dt.datetime) -> None:
    dated = files.filter("snapshot_date IS NOT NULL")
    undated = _gold_outcomes(
        files.filter("snapshot_date IS NULL"), rules.FAILED, run_id, "no snapshot date in the file name"
    )
    try:
        history = scd2.bulk_history_by_city(lake.silver(dated), now.isoformat())
        _publish(lake, history, BULK, now, file_hashes=dated, by_city=True)
    except Exception as failure:
        lake.lineage.record(
            _gold_outcomes(dated, rules.FAILED, run_id, str(failure)).unionByName(undated), now
        )
        raise
    lake.lineage.record(_gold_outcomes(dated, rules.SUCCESS, run_id).unionByName(undated), now)


def _publish_in_order(
    lake: Lake, files: DataFrame, run_id: str | None, now: dt.datetime, late: str, copies: str
) -> None:
    """All files by date, then name and hash, in one pass and one version.

    A rebuild, and a pass that fails, take the files one by one, each as a version
    of its own, so that the file that fails is known. The outcomes are recorded
    together at the end. A run that dies before that loses nothing: the next one
    finds the files among the committed ones.
    """
    day = F.coalesce("snapshot_date", F.lit(now.date()))
    ordered = files.withColumn("day", day).orderBy("day", "file_name", "file_hash")
    if late == MERGE:
        try:
            named = ordered.select("file_hash", "file_name", "day")
            rows = lake.silver(files).join(named, "file_hash")
            merge_batches(lake, rows, F.col("day"), now, ["file_name", "file_hash"], files, copies=copies)
        except Exception as failure:
            _log.warning("merging all files at once failed, so they are taken one by one: %s", failure)
        else:
            lake.lineage.record(_gold_outcomes(files, rules.SUCCESS, run_id), now)
            return
    failed = None
    for file in ordered.toLocalIterator():
        one = files.filter(F.col("file_hash") == file["file_hash"])
        try:
            merge_batch(
                lake, lake.silver(one), file["day"], now, file_hashes=one, late=late, copies=copies
            )
        except Exception as failure:
            failed = (one, failure)
            break
    finished = files.join(lake.gold.committed_files().distinct(), "file_hash", "left_semi")
    outcomes = _gold_outcomes(finished, rules.SUCCESS, run_id)
    if failed:
        outcomes = outcomes.unionByName(
            _gold_outcomes(failed[0], rules.FAILED, run_id, str(failed[1]))
        )
    lake.lineage.record(outcomes, now)
    if failed:
        raise failed[1]


def _publish(lake: Lake, rows: DataFrame, mode: str, now: dt.datetime, *args, **options) -> None:
    """Publishes rows that meet the expectations; they are watched while they are written."""
    watched, check = quality.expected(rows)
    lake.gold.publish(watched, mode, now, *args, check=check, **options)


def merge_batch(
    lake: Lake,
    silver: DataFrame,
    day: dt.date,
    now: dt.datetime,
    file_hashes: DataFrame | None = None,
    batch_key: str | None = None,
    late: str = MERGE,
    copies: str = scd2.ONCE,
) -> None:
    """Merge the Silver rows of one date into both Gold tables as one version."""
    ids = ("table_name", *scd2.MERGE_KEYS)
    stamp = now.isoformat()
    incoming = scd2.incoming_versions(silver, F.lit(day), stamp)
    gold = lake.gold.read()
    if late == REBUILD:
        late_rows, on_time = scd2.split_late(incoming, gold, ids)
        late_days = stored(late_rows.select(*ids, "valid_from").distinct())
        if not late_days.isEmpty():
            _rebuild_and_merge(lake, gold, late_days, on_time, day, now, file_hashes, batch_key, copies)
            return
    merged = scd2.merge_open(
        scd2.current_rows(gold), incoming, F.lit(day), stamp, ids, copies=copies
    )
    _publish(lake, merged, MERGE, now, file_hashes, batch_key, keeps_closed=True)


def merge_batches(
    lake: Lake,
    silver: DataFrame,
    day: Column,
    now: dt.datetime,
    steps: Sequence[str] = (),
    file_hashes: DataFrame | None = None,
    batch_key: str | None = None,
    copies: str = scd2.ONCE,
) -> None:
    """Merge Silver rows of many dates into both Gold tables as one version.

    The rows are applied by day, and within a day by the columns in ``steps``.
    """
    stamp = now.isoformat()
    traded = scd2.enrich(scd2.only_traded(silver), stamp, day)
    incoming = scd2.conform(traded, "table_name", *steps)
    merged = scd2.replay_open(
        scd2.current_rows(lake.gold.read()), incoming, stamp, ("table_name", *scd2.MERGE_KEYS),
        copies=copies, steps=["valid_from", *steps],
    )
    _publish(lake, merged, MERGE, now, file_hashes, batch_key, keeps_closed=True)


def _rebuild_and_merge(
    lake: Lake,
    gold: DataFrame,
    late_days: DataFrame,
    on_time: DataFrame,
    day: dt.date,
    now: dt.datetime,
    file_hashes: DataFrame | None,
    batch_key: str | None,
    copies: str,
) -> None:
    """Late ids get a new history from all of Silver, the rest a normal merge.

    Refused if Silver lacks the day of a late row, or of any version that the new
    history replaces: it would be lost.
    """
    ids = ("table_name", *scd2.MERGE_KEYS)
    stamp = now.isoformat()
    days = scd2.only_traded(scd2.has_city(lake.silver())).select(
        *ids, F.col("snapshot_date").alias("valid_from")
    )
    late_ids = late_days.select(*ids).distinct()
    replaced = scd2.has_city(gold).select(*ids, "valid_from").join(late_ids, list(ids), "left_semi")
    lost = replaced.unionByName(late_days).join(days, [*ids, "valid_from"], "left_anti")
    if not lost.isEmpty():
        raise ValueError(f"Silver lacks rows of stored versions, for example of {lost.first().asDict()}")
    # the merge reads it several times
    rebuilt = stored(scd2.rebuild_late(gold, lake.silver(), late_ids, stamp, ids))
    merged = scd2.merge(rebuilt, on_time, F.lit(day), stamp, ids, copies=copies)
    _publish(lake, merged, REBUILD, now, file_hashes, batch_key)


# ------------------------------------------------------------------ export


def export_history(lake: Lake, table: str, folder: str) -> None:
    """Write all versions of ids that have several as CSV with a header, in order."""
    history = quality.history_export(lake.gold.read(table))
    history.write.mode("overwrite").option("header", True).csv(folder)


# ------------------------------------------------------------------ rollback


def rollback_layer(lake: Lake, layer: str, now: dt.datetime) -> None:
    """Take a layer back to the end of the one before: data, lineage and stream position."""
    if layer == rules.GOLD:
        lake.gold.reset(now)
    elif layer == rules.SILVER:
        _empty(lake.silver(), lake.silver_dir)
    elif layer == rules.BRONZE:
        _empty(lake.bronze(), lake.bronze_dir)
    else:
        raise ValueError(f"unknown layer {layer!r}")
    lake.lineage.delete_layer(layer, now)
    lake.restart_stream(layer, now)


def _empty(rows: DataFrame, folder: str) -> None:
    rows.limit(0).write.mode("overwrite").parquet(folder)
