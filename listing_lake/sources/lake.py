"""The lake's folders and its per-file Bronze and Silver datasets.

Both datasets are partitioned by the content hash of the raw file, so writing a
file again replaces exactly its own rows and two files of one name never meet.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StringType, StructField, StructType

from listing_lake import schemas
from listing_lake.session import CODEC, FREED
from listing_lake.sources import commits
from listing_lake.sources.gold_store import TABLES, GoldStore
from listing_lake.sources.lineage_table import LineageTable

BRONZE_ON_DISK = StructType(
    [
        *schemas.BRONZE,
        StructField("raw_record", StringType()),
        StructField("error", StringType()),
        StructField("quarantined", BooleanType()),
        StructField("file_hash", StringType()),
    ]
)
SILVER_ON_DISK = StructType(
    [
        *schemas.SILVER,
        StructField("snapshot_date", DateType()),
        StructField("file_hash", StringType()),
    ]
)


_SEEN = "path string, length bigint, modified timestamp, file_hash string"
_RESTARTS = "layer string, restarted_at timestamp"


class Lake:
    """``max_retries``: failures after which a file is set aside; None tries for ever."""

    def __init__(
        self, spark: SparkSession, root: str, landing: str | None = None, max_retries: int | None = None
    ):
        self.spark, self.root, self.max_retries = spark, root.rstrip("/"), max_retries
        self.landing = landing or f"{self.root}/landing"
        # the steps of a lake are many; without it what each has shuffled stays until the driver
        # happens to collect its garbage
        spark.conf.set(*FREED)
        self.bronze_dir = f"{self.root}/bronze"
        self.silver_dir = f"{self.root}/silver"

    @cached_property
    def lineage(self) -> LineageTable:
        return LineageTable(self.spark, f"{self.root}/lineage", self.max_retries)

    @cached_property
    def gold(self) -> GoldStore:
        return GoldStore(self.spark, f"{self.root}/gold")

    # ------------------------------------------------------------ landing

    def seen(self) -> DataFrame:
        """What landing files were when they were last hashed, and their hashes."""
        schema = self.spark.createDataFrame([], _SEEN).schema
        return commits.read_or_empty(self.spark, f"{self.root}/seen", schema)

    def remember(self, prints: DataFrame) -> None:
        prints.select("path", "length", "modified", "file_hash").write.mode("append").parquet(
            f"{self.root}/seen"
        )

    # ------------------------------------------------------------ streams

    def checkpoint(self, layer: str) -> str:
        """Where the stream of a layer keeps its position; a rollback begins a new one."""
        return f"{self.root}/streams/{layer.lower()}-{self._restarts().filter(F.col('layer') == layer).count()}"

    def _restarts(self) -> DataFrame:
        schema = self.spark.createDataFrame([], _RESTARTS).schema
        return commits.read_or_empty(self.spark, f"{self.root}/restarts", schema)

    def restart_stream(self, layer: str, now: dt.datetime) -> None:
        commits.append(self.spark.createDataFrame([(layer, now)], _RESTARTS), f"{self.root}/restarts")

    # ------------------------------------------------------------ Bronze

    def bronze(self, files: DataFrame | None = None) -> DataFrame:
        """Clean raw rows of the given files (file_hash), or of all."""
        stored = self._rows(self.bronze_dir, "quarantined=false", BRONZE_ON_DISK)
        return self._of(stored, files).select(*schemas.BRONZE.names, "file_hash")

    def bronze_as_landed(self, files: DataFrame | None = None) -> DataFrame:
        """Clean raw rows with every column that some file had beyond those of the feed.

        Reads the footers of all Bronze files to find them.
        """
        try:
            stored = (
                self.spark.read.option("basePath", self.bronze_dir)
                .option("mergeSchema", True)
                .parquet(f"{self.bronze_dir}/quarantined=false/file_hash=*")
            )
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.bronze(files)
        return self._of(stored, files).drop("raw_record", "error", "quarantined")

    def quarantine(self, files: DataFrame | None = None) -> DataFrame:
        """Records and files that could not be taken in, with the reason."""
        stored = self._rows(self.bronze_dir, "quarantined=true", BRONZE_ON_DISK)
        return self._of(stored, files).select("file_hash", "raw_record", "error", "_source_file")

    def bronze_facts(self, files: DataFrame) -> DataFrame:
        return self._facts(self._stored(self.bronze_dir, "quarantined=false", BRONZE_ON_DISK), files)

    def write_bronze(self, rows: DataFrame) -> None:
        _replace_partitions(rows, self.bronze_dir, "quarantined", "file_hash")

    # ------------------------------------------------------------ Silver

    def silver(self, files: DataFrame | None = None) -> DataFrame:
        return self._of(self._rows(self.silver_dir, "snapshot_date=*", SILVER_ON_DISK), files)

    def silver_facts(self, files: DataFrame) -> DataFrame:
        return self._facts(self._stored(self.silver_dir, "snapshot_date=*", SILVER_ON_DISK), files)

    def write_silver(self, rows: DataFrame) -> None:
        _replace_partitions(rows, self.silver_dir, "snapshot_date", "file_hash")

    # ------------------------------------------------------------ SQL

    def register_views(self, prefix: str = "lake") -> list[str]:
        """Temporary views of the session over the lake as it is now; returns their names."""
        views = {
            "bronze": self.bronze(),
            "quarantine": self.quarantine(),
            "silver": self.silver(),
            "lineage": self.lineage.read(),
            **{table: self.gold.read(table) for table in TABLES},
        }
        for name, rows in views.items():
            rows.createOrReplaceTempView(f"{prefix}_{name}")
        return [f"{prefix}_{name}" for name in views]

    # ------------------------------------------------------------ files

    def _stored(self, root: str, outer: str, schema: StructType) -> DataFrame | None:
        """All rows below the folders that fit, None where there is no such folder."""
        try:
            return (
                self.spark.read.schema(schema)
                .option("basePath", root)
                .parquet(f"{root}/{outer}/file_hash=*")
            )
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _rows(self, root: str, outer: str, schema: StructType) -> DataFrame:
        stored = self._stored(root, outer, schema)
        return self.spark.createDataFrame([], schema) if stored is None else stored

    @staticmethod
    def _of(rows: DataFrame, files: DataFrame | None) -> DataFrame:
        """Rows of some files.

        The condition on the hashes changes nothing, but lets Spark take the join
        for a selective one and prune the folders of all other files at run time.
        """
        if files is None:
            return rows
        wanted = files.select("file_hash").filter("file_hash > ''")
        return rows.join(wanted, "file_hash", "left_semi").select(*rows.columns)

    def _facts(self, stored: DataFrame | None, files: DataFrame) -> DataFrame:
        """Row count and bytes on disk of some files, from file metadata only."""
        if stored is None:
            return self.spark.createDataFrame(
                [], "file_hash string, row_count bigint, file_size_bytes bigint"
            )
        rows = stored.select("file_hash", "_metadata.file_path", "_metadata.file_size")
        parts = self._of(rows, files).groupBy("file_hash", "file_path", "file_size").agg(
            F.count(F.lit(1)).alias("rows")
        )
        return parts.groupBy("file_hash").agg(
            F.sum("rows").alias("row_count"), F.sum("file_size").alias("file_size_bytes")
        )


def _replace_partitions(rows: DataFrame, root: str, *partitions: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(*partitions)
        .parquet(root)
    )
