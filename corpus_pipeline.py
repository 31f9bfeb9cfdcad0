"""A training-data pipeline over ``documents``, each stage one operator of ``fernweave.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fernweave.llm import bpe, minhash_dedup, mixing, quality_rules
from fernweave.llm.common import dropped, shared_dir, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.judge_quality(docs, "text").where("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies (five-word shingles, 80 percent)."""
    return minhash_dedup.deduplicated(docs, "doc_id", "text", *NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes from each document; documents taken twice stand there twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, decoded again for the digests of ``op1``."""
    return bpe.digests(docs, ["doc_id", "lang", "source", "n_chars"], ids=True, part=CACHES)


#: Percent of a link, bands and rows of ``near_dedup``: a pair at 0.8 is missed with a probability below 1e-6.
NEAR = (80, 35, 5)
#: Part of the encoder's caches that ``encode`` takes: its executors' JVMs have grown in the stages before.
CACHES = 0.5

STAGES = [("quality", quality), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]

#: Seeded block selection and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage read is removed once its result is written, all but the last stage's input."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            at = shared_dir(spark)
            docs = written(docs, at)
            if before:
                dropped(spark, before)
            before = at
    return docs
