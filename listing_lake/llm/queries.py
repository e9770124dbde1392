"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_lake.llm import (
    ann,
    chat,
    codes,
    decontam,
    langid,
    linedup,
    negatives,
    packing,
    quality,
    secret_scan,
    simhash,
    token_store,
    toxicity,
)
from listing_lake.llm.common import table
from listing_lake.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]


def _packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def _langid(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(table(spark, sf, "documents"))


def _chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.digests(chat.render(chat.with_probe(spark, sf)))


def _simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def _ann(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(table(spark, sf, "embeddings"))


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def _decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def _toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def _secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf, "documents"))


def _line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return linedup.drop_recurring(table(spark, sf, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


def _token_store(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_dir(spark, "ids")
    token_store.write(table(spark, sf, "documents"), folder)
    return token_store.read(spark, folder)


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    coded, _ = codes.compress(table(spark, sf, "embeddings"))
    return codes.with_label_error(coded)


def _negatives(spark: SparkSession, sf: str) -> DataFrame:
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf, "embeddings").withColumn("label", other))


def queries() -> dict[str, Query]:
    return {
        "op1_best_fit_packing": _packing,
        "op2_language_id": _langid,
        "op3_chat_formatting": _chat,
        "op4_simhash": _simhash,
        "op5_nearest_neighbours": _ann,
        "op6_quality_cotraining": _quality,
        "op7_decontamination": _decontamination,
        "op8_toxicity": _toxicity,
        "op9_secret_scan": _secrets,
        "op10_line_dedup": _line_dedup,
        "op11_token_store": _token_store,
        "op12_vector_codes": _codes,
        "op13_hard_negatives": _negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op10_line_dedup": linedup.ORACLE_SQL,
        "op12_vector_codes": codes.ORACLE_SQL,
        "op13_hard_negatives": negatives.ORACLE_SQL,
    }
