"""Documents to packed sequences, in stages that each write their result.

All stages but the last return the columns of documents. Rows with a null id pass
every filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_lake.llm import decontam, linedup, packing, simhash
from listing_lake.llm import toxicity as toxic
from listing_lake.llm.common import table
from listing_lake.session import stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are predicted to be toxic."""
    return toxic.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines whose template recurs in other documents, but for its first document."""
    n_lines, n_dropped = (_unused(docs, name) for name in ("n_lines", "n_dropped"))
    found = linedup.drop_recurring(docs, n_lines, n_dropped)
    if "n_chars" in docs.columns:
        changed = F.when(F.col(n_dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", changed)
    return found.drop(n_lines, n_dropped).select(*["`" + c.replace("`", "``") + "`" for c in docs.columns])


def _unused(docs: DataFrame, name: str) -> str:
    """A name that no column of docs has."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts every kept document into sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Trained models, hashes and tokenizers cannot be said in SQL; tests/llm holds brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
