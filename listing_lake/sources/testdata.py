"""Listing feed derived from the star-schema test tables.

Every line item becomes one listing row of a monthly snapshot. The derived
columns carry the kinds of dirt a real feed has: text prices, prices above the
cap, moving and missing cities, coordinates outside the fence, blank agencies,
four date notations plus junk, and several rows of one id in a snapshot.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_lake.operators.silver import silver_clean

# the file writer below runs in tasks that need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INGESTED_AT = "2025-01-01T00:00:00+00:00"
TRANSFORMED_AT = "2025-01-02T00:00:00+00:00"
LOADED_AT = "2025-01-03T00:00:00+00:00"
RUN_ID = "run-1"

TIE_BREAK = ("l_orderkey", "l_linenumber", "l_suppkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal out a table that has fewer splits than the session has cores.

    The test files are single splits; a table of real size has many and passes
    through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _text(column: Column) -> Column:
    return column.cast("string")


def _date_text(day: Column, style: Column) -> Column:
    return (
        F.when(style == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(style == 1, F.date_format(day, "MMMM d, yyyy"))
        .when(style == 2, F.date_format(day, "M-d-yyyy"))
        .when(style == 3, F.date_format(day, "M/d/yyyy"))
        .when(style == 4, F.lit("########"))
        .otherwise(F.lit("unknown"))
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`listed` makes listings of: one narrow row for each, with snapshot date and tie-break."""
    # the joins carry what the listing takes from a line item, not the figures it is derived from
    rented = F.col("l_returnflag") == "R"
    line = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            rented.alias("rented"),
            F.floor(F.col("l_extendedprice") / 20000.0).alias("steps"),
            F.col("l_shipdate").cast("date").alias("ship_day"),
        )
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    place = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("l_partkey")
    home = F.when(key % 50 == 0, F.col("s_nationkey")).otherwise((key % 25).cast("int"))
    return (
        # the part last: its texts move once, and rows of one part stay together
        line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, key == F.col("p_partkey"))
        .join(place, F.col("n_nationkey") == home)
        .select(
            *TIE_BREAK,
            "l_partkey",
            "rented",
            "steps",
            "ship_day",
            "s_name",
            "p_name",
            "p_type",
            "p_size",
            "n_nationkey",
            "n_name",
            "r_name",
            F.trunc("ship_day", "month").alias("snapshot_date"),
        )
    )


def listing() -> dict[str, Column]:
    """The raw columns of a listing (all text) over its facts."""
    key, number = F.col("l_partkey"), F.col("l_linenumber")
    rented, ship_day = F.col("rented"), F.col("ship_day")
    amount = F.col("steps") * F.when(rented, 500).otherwise(200_000_000)
    return {
        "property_id": _text(key),
        "location_id": _text(F.col("n_nationkey")),
        "page_url": F.concat(F.lit("https://listing.example/"), _text(key)),
        "property_type": F.col("p_type"),
        "price": F.when(number == 7, F.lit("N/A"))
        .when(number == 6, F.concat(_text(amount), F.lit(".0")))
        .otherwise(_text(amount)),
        "location": F.col("p_name"),
        "city": F.when(key % 97 != 0, F.col("n_name")),
        "province_name": F.col("r_name"),
        "latitude": _text(F.col("n_nationkey") + 20),
        "longitude": _text(F.col("n_nationkey") + 58),
        "baths": _text(F.col("p_size") % 5),
        "bedrooms": _text(F.col("p_size") % 4),
        "purpose": F.when(rented & (number == 5), F.lit("Short Stay"))
        .when(rented, F.lit("For Rent"))
        .otherwise(F.lit("For Sale")),
        "date_added": _date_text(ship_day, F.col("l_orderkey") % 6),
        "agency": F.when(F.col("l_suppkey") % 3 == 0, F.lit(""))
        .when(F.col("l_suppkey") % 3 == 1, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.col("s_name"), F.lit(" "))),
        "agent": F.when(number != 1, F.col("s_name")),
        "Area Type": F.when(key % 3 == 0, F.lit("Kanal"))
        .when(key % 3 == 1, F.lit("KANAL"))
        .otherwise(F.lit("Marla")),
        "Area Size": F.when(key % 11 == 0, F.lit("0"))
        .when(key % 13 == 0, F.lit("n/a"))
        .otherwise(_text(F.col("p_size"))),
    }


def listed(rows: DataFrame) -> DataFrame:
    """Raw listing rows of facts, with snapshot date, tie-break and line end (if any)."""
    end = [name for name in ("_line_end",) if name in rows.columns]
    raw = [column.alias(name) for name, column in listing().items()]
    return rows.select(*raw, "snapshot_date", *TIE_BREAK, *end)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing rows (all text) with snapshot date and tie-break columns."""
    return listed(facts(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).withColumns(
        {
            "_ingested_at": F.lit(INGESTED_AT),
            "_run_id": F.lit(RUN_ID),
            "_source_file": F.concat(
                F.lit("property_data_"), F.col("snapshot_date").cast("string"), F.lit(".csv")
            ),
        }
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_clean(
        bronze(spark, sf_dir), RUN_ID, TRANSFORMED_AT, carry=("snapshot_date", *TIE_BREAK)
    )


# ---------------------------------------------------------------- derived files


#: Fields as the csv module of Python quotes them; NULL and empty texts are both empty.
_CSV = {
    "escape": '"', "emptyValue": "", "nullValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_landing(
    rows: DataFrame,
    folder: str,
    split_days: bool = True,
    judge: Callable[[DataFrame], DataFrame] | None = None,
    show: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Write rows as landing CSV files named after their snapshot date.

    Spark makes the lines; every task writes the dates it holds as files of its
    own, streaming through its lines, so nothing is gathered. ``_line_end`` in the
    rows, if present, is appended to each line as it is. ``split_days=False`` gives
    one file per date.

    ``judge`` chooses among the rows when they are dealt out (with one file per date, all
    rows of a date are together), and ``show`` makes the columns of the files of them when
    they are in order: what moves and is sorted are the rows as they come, so give narrow ones.
    Returns the number of files.
    """
    # ranges keep a date's rows together, and split a date that owns most of them if allowed
    order = ("snapshot_date", *TIE_BREAK)
    dealt = rows.repartitionByRange(*(order if split_days else order[:1]))
    ordered = (judge(dealt) if judge else dealt).sortWithinPartitions(*order)
    rows = show(ordered) if show else ordered
    header = [name for name in rows.columns if name not in (*TIE_BREAK, "snapshot_date", "_line_end")]
    head = (",".join(header) + "\n").encode()

    def write(batches):
        from pyarrow import compute, fs
        from pyspark import TaskContext

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        part, day, stream, files = TaskContext.get().partitionId(), None, None, 0
        for batch in batches:
            runs = compute.run_end_encode(batch.column(0))
            start = 0
            for date, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if stream is None or date != day:
                    if stream is not None:
                        stream.close()
                    stream = system.open_output_stream(f"{root}/property_data_{date}_{part}.csv")
                    stream.write(head)
                    day, files = date, files + 1
                lines = batch.column(1).slice(start, end - start)
                stream.write("".join(lines.to_pylist()).encode())
                start = end
        if stream is not None:
            stream.close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int32())})

    ends = F.coalesce(F.col("_line_end"), F.lit("")) if "_line_end" in rows.columns else F.lit("")
    line = F.concat(F.to_csv(F.struct(*[F.col(f"`{name}`") for name in header]), _CSV), ends, F.lit("\n"))
    lines = rows.select(F.col("snapshot_date").cast("string"), line.alias("line"))
    return lines.mapInArrow(write, "files int").agg(F.sum("files")).first()[0]


def write_files(rows: DataFrame, folder: str) -> int:
    """Write each row (file_name, content) as a file of its own. Returns the number of files."""

    def write(batches):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for name, content in zip(batch["file_name"], batch["content"]):
                with system.open_output_stream(f"{root}/{name}") as stream:
                    stream.write(content.encode())
            yield pd.DataFrame({"files": [len(batch)]})

    return rows.mapInPandas(write, "files int").agg(F.sum("files")).first()[0]
