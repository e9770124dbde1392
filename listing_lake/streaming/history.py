"""Type 2 history as a stream with keyed state, one small state for each table and id.

A stream that merges by rewriting all open versions pays for every id on every
batch. Here the open values of an id are its state: a batch costs what it changes.
An id that no batch has brought yet has no state; what was open before the stream
meets its first rows in a join, so that no Python call is spent on the other ids.
The stream carries counted (id, day, file, value) rows only and appends events:

* ``opened``: version number ``nth`` of an id begins with the rows of one file;
* ``ended``: that version ends at ``day``, by ``copies`` rows of another value.

Wide rows stay in Silver; :func:`history` joins them with the events. State, events
and position move together with the checkpoint, so a run that died is started
again and nothing is doubled or lost. The rules are those of ``scd2.merge_open``, one
batch for each day and file, by day and then file hash within a run. Rows with a
NULL id or value open a version each and never end, so they need no state.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from listing_lake.operators import scd2
from listing_lake.sources import commits
from listing_lake.sources.lake import SILVER_ON_DISK

IDS = ("table_name", *scd2.MERGE_KEYS)
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_COUNTED = "table_name string, property_id long, price long, day date, file_hash string, n long"
EVENTS = (
    "table_name string, property_id long, price long, nth long, event string, day date, file_hash string, copies long"
)
_BEGUN = "table_name string, property_id long, begun array<long>"
_NAMES = [field.split()[0] for field in EVENTS.split(", ")]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts equal rows before the shuffle, so that a hot id sends few."""
    for batch in batches:
        columns = batch.schema.names[:-1]
        sums = pa.table(batch).group_by(columns).aggregate([("n", "sum")])
        found = sums.select([*columns, "n_sum"]).rename_columns(batch.schema.names)
        yield from found.combine_chunks().to_batches()


class Versions(StatefulProcessor):
    """Open values of one id, with the numbers of their versions."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("versions", "open array<struct<price: bigint, nth: bigint>>, made bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        steps: dict = defaultdict(Counter)
        before_stream = ()
        for row in rows:
            steps[row["day"], row["file_hash"] or ""][row["price"]] += row["n"]
            before_stream = row["begun"] or ()
        held = self.state.get()
        # versions that were there before the stream all have number 0
        still_open, made = (dict(held[0]), held[1]) if held else ({price: 0 for price in before_stream}, 0)
        events = []
        for (day, file_hash), counts in sorted(steps.items()):
            known, before = sum(counts.values()), dict(still_open)
            for price, nth in before.items():
                if copies := known - counts[price]:
                    events.append((price, nth, "ended", day, file_hash, copies))
                    del still_open[price]
            for price in sorted(+counts):
                if price not in before:
                    made += 1
                    still_open[price] = made
                    events.append((price, made, "opened", day, file_hash, None))
        if events:
            self.state.update((sorted(still_open.items()), made))
        for event in events:
            yield Row(**dict(zip(_NAMES, (*key, *event))))

    def close(self) -> None:
        pass


def _with_table(silver: DataFrame) -> DataFrame:
    return scd2.only_traded(silver.filter("snapshot_date IS NOT NULL")).withColumn(
        "file_hash", F.coalesce("file_hash", F.lit(""))
    )


def _begun(spark: SparkSession, checkpoint: str, gold: DataFrame | None) -> DataFrame:
    """The values of each id that were open before the first run, kept with the stream's position.

    They are written before the stream has a position; a run that died on the way writes them anew.
    """
    folder = f"{checkpoint}/begun"
    if gold is not None and commits.read_or_empty(spark, f"{checkpoint}/metadata", "value string", "text").isEmpty():
        values = scd2.current_rows(gold).dropna(subset=[*IDS, "price"]).groupBy(*IDS)
        values.agg(F.collect_set("price").alias("begun")).write.mode("overwrite").parquet(folder)
    return commits.read_or_empty(spark, folder, _BEGUN)


def stream_versions(
    spark: SparkSession, silver_folder: str, events_folder: str, checkpoint: str, gold: DataFrame | None = None
) -> StreamingQuery:
    """Appends the events of new Silver files; ``gold``: versions that were there before the first run."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    rows = _with_table(spark.readStream.schema(SILVER_ON_DISK).parquet(silver_folder)).dropna(subset=["property_id", "price"])
    counted = rows.select(
        *IDS, "price", F.col("snapshot_date").alias("day"), "file_hash", F.lit(1).cast("long").alias("n")
    ).mapInArrow(_counted, _COUNTED)
    events = counted.join(_begun(spark, checkpoint, gold), list(IDS), "left").groupBy(*IDS).transformWithState(
        statefulProcessor=Versions(), outputStructType=EVENTS, outputMode="append", timeMode="none"
    )
    query = (
        events.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(events_folder)
    )
    query.awaitTermination()
    return query


def history(
    gold: DataFrame, silver: DataFrame, events: DataFrame, loaded_at: str, copies: str = scd2.ONCE
) -> DataFrame:
    """All versions: those there before the stream, and those that it opened from Silver rows."""
    pair = [*IDS, "price"]
    opened = events.filter("event = 'opened'").select(*pair, F.col("day").alias("snapshot_date"), "file_hash", "nth")
    ended = events.filter("event = 'ended'").select(
        *pair, "nth", F.col("day").alias("_ended"), F.col("copies").alias("_copies")
    )
    traded = scd2.enrich(_with_table(silver), loaded_at, F.col("snapshot_date"))
    found = traded.join(opened, [*pair, "snapshot_date", "file_hash"])
    unknown = traded.filter("property_id IS NULL OR price IS NULL").withColumn("nth", F.lit(None).cast("long"))
    begun = scd2.conform(found.unionByName(unknown), "table_name", "nth")
    rows = scd2.current_rows(gold).withColumn("nth", F.lit(0).cast("long")).unionByName(begun)
    judged = rows.join(ended, [*pair, "nth"], "left")
    return scd2.closed_rows(gold).unionByName(
        scd2.end_versions(judged, gold.columns, F.col("_ended"), loaded_at, copies)
    )
