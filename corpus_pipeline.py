"""From raw documents to packed token sequences: five stages, each over all rows its predecessor kept.

Every stage takes (spark, docs, sf_dir); ``run`` writes each result as Parquet in the shared folder and
rereads it, so a lost executor costs one stage at most. All but the last return the columns of
``documents``; the last returns one boundary record per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.llm import decontamination, packing, pii, quality, simhash
from ridemart.llm.common import crc_mod, read_table, stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below 0.3) go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the least id."""
    return simhash.one_per_group(docs, shingle=3, max_distance=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to surrogates; n_chars follows the text."""
    return pii.without_personal_data(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("quality_classifier", quality_filter), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontaminate), ("pii_surrogates", replace_personal_data),
          ("concat_packing", pack_sequences)]

#: A trained classifier, a BPE tokenizer and 64-bit XXH64 are not SQL; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
