"""File lineage: which file reached which layer, with what outcome.

The lineage is a small DataFrame keyed by (file_hash, layer). Upserts are one
aggregation over all records of a run, not one statement per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_lake import rules, schemas

KEY = ("file_hash", "layer")

# What the last record of a key decides.
_LAST_WINS = ("file_name", "run_id", "status", "row_count", "file_size_bytes", "error_message")


def upsert(lineage: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Apply outcome records in ``seq`` order.

    The last record of a key gives its values. Every FAILED record raises
    ``retry_count`` by one, except one that creates the key. ``created_at``
    stays; ``updated_at`` moves for every key the batch touches.
    """
    failed = F.col("status") == rules.FAILED
    batch = outcomes.groupBy(*KEY).agg(
        F.max_by(F.struct(*_LAST_WINS), F.col("seq")).alias("_last"),
        F.min_by(failed, F.col("seq")).alias("_first_failed"),
        F.count_if(failed).alias("_failures"),
    )
    old, new = lineage.alias("old"), batch.alias("new")
    same_key = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in KEY]
    both = old.join(new, same_key, "full_outer")
    touched = F.col("new.file_hash").isNotNull()
    created = F.col("old.file_hash").isNull()
    failures = F.coalesce(F.col("_failures"), F.lit(0)) - F.when(
        created & F.col("_first_failed"), 1
    ).otherwise(0)

    columns: dict[str, Column] = {k: F.coalesce(f"new.{k}", f"old.{k}") for k in KEY}
    columns |= {
        name: F.when(touched, F.col(f"_last.{name}")).otherwise(F.col(f"old.{name}"))
        for name in _LAST_WINS
    }
    columns["retry_count"] = F.coalesce("old.retry_count", F.lit(0)) + failures
    columns["created_at"] = F.coalesce(F.col("old.created_at"), now)
    columns["updated_at"] = F.when(touched, now).otherwise(F.col("old.updated_at"))
    return both.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.LINEAGE]
    )


def set_aside(lineage: DataFrame, max_retries: int | None) -> DataFrame:
    """Turn FAILED files that used up their retries into QUARANTINED ones; None: never."""
    if max_retries is None:
        return lineage
    spent = (F.col("status") == rules.FAILED) & (F.col("retry_count") >= max_retries)
    return lineage.withColumn(
        "status", F.when(spent, F.lit(rules.QUARANTINED)).otherwise(F.col("status"))
    )


def release(lineage: DataFrame, file_hash: str, now: Column) -> DataFrame:
    """Turn a QUARANTINED file into a FAILED one without retries, to be tried again."""
    freed = (F.col("file_hash") == file_hash) & (F.col("status") == rules.QUARANTINED)
    changes = {"status": F.lit(rules.FAILED), "retry_count": F.lit(0), "updated_at": now}
    return lineage.select(
        *[
            F.when(freed, changes[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in changes
            else F.col(f.name)
            for f in schemas.LINEAGE
        ]
    )


# ------------------------------------------------------------ selection


def in_state(lineage: DataFrame, layer: str, *states: str) -> DataFrame:
    return lineage.filter((F.col("layer") == layer) & F.col("status").isin(*states))


def unprocessed(files: DataFrame, lineage: DataFrame, layer: str) -> DataFrame:
    """Files this layer has neither finished nor set aside.

    One side of the join is one row per known file; whether that is small
    enough to broadcast is left to its statistics.
    """
    known = in_state(lineage, layer, rules.SUCCESS, rules.QUARANTINED).select("file_hash")
    return files.join(known, "file_hash", "left_anti")


def eligible(lineage: DataFrame, layer: str, previous: str) -> DataFrame:
    """Files the previous layer finished and this one has not."""
    ready = in_state(lineage, previous, rules.SUCCESS).select(
        "file_hash", "file_name", "row_count"
    )
    return unprocessed(ready, lineage, layer)


def first_files(files: DataFrame, limit: int, *order: str) -> DataFrame:
    """The first ``limit`` files in order; 0 means all of them."""
    return files.orderBy(*order).limit(limit) if limit > 0 else files


def delete_layer(lineage: DataFrame, layer: str) -> DataFrame:
    return lineage.filter(F.col("layer") != layer)


# ------------------------------------------------------------ reports


def _megabytes(size: Column) -> Column:
    return F.round(size / 1e6, 1)


def status_counts(lineage: DataFrame) -> DataFrame:
    return (
        lineage.groupBy("layer", "status")
        .agg(F.count(F.lit(1)).alias("files"))
        .orderBy("layer", "status")
    )


def volume(lineage: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("file_size_bytes"), F.lit(0))
    return (
        lineage.filter(F.col("status") == rules.SUCCESS)
        .groupBy("layer")
        .agg(
            F.sum("row_count").alias("total_rows"),
            F.sum("file_size_bytes").alias("total_bytes"),
            _megabytes(total).alias("total_mb"),
        )
    )


def listing(lineage: DataFrame) -> DataFrame:
    return lineage.select(
        "file_name",
        "layer",
        "status",
        "row_count",
        "file_size_bytes",
        _megabytes(F.col("file_size_bytes")).alias("size_mb"),
        "created_at",
    ).orderBy("layer", "created_at")


def failed(lineage: DataFrame) -> DataFrame:
    return lineage.filter(F.col("status") == rules.FAILED).select(
        "file_name", "layer", "error_message", "retry_count"
    )


def of_run(lineage: DataFrame, run_id: str) -> DataFrame:
    return lineage.filter(F.col("run_id") == run_id)


def retry_watch(lineage: DataFrame) -> DataFrame:
    """Failed files, the most retried first."""
    return (
        lineage.filter(F.col("status") == rules.FAILED)
        .select("file_hash", "layer", "file_name", "retry_count", "error_message")
        .orderBy(F.desc("retry_count"), "layer", "file_hash")
    )
