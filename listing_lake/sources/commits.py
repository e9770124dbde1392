"""Append-only commit logs: small Parquet folders read with a fixed schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str, kind: str = "parquet") -> DataFrame:
    """The folder's rows, or none where nothing was written yet."""
    try:
        return spark.read.schema(schema).format(kind).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append(df: DataFrame, path: str) -> None:
    """One commit is one file, so it appears whole or not at all."""
    df.coalesce(1).write.mode("append").parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder, wherever Hadoop finds it; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
