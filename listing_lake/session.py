"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the jobs here expect of a cluster session. Skewed join partitions are
# split even where that costs one more shuffle; windows and aggregates need no
# such help because they run on rows that were reduced before the shuffle.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # the cleaning projection is long; above 8000 bytes the JVM would interpret
    # its generated method instead of compiling it
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Shuffle files go when the query that wrote them ends.
FREED = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
#: Of the lake's files: digests are hexadecimal, which an entropy coder halves.
CODEC = "zstd"


def build_session(master: str | None = None, app: str = "listing-lake", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local session without the setting falls back to a temporary folder;
    a cluster without it is an error, since a machine-local folder would be
    lost with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="listing-lake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)  # later calls find the same folder
    return named.rstrip("/")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows as a written table in the shared folder.

    Cuts the lineage so that lost executors do not replay the past, and keeps
    column pruning and filter pushdown for whatever reads the rows next.
    """
    folder = work_dir(df.sparkSession, "table")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
