"""The corpus pipeline: five operators of ``quarryline.llm``, one after the other, over ``documents``.

Each stage works on what its predecessor kept, and all but the last return the columns of ``documents``.
Defined cases, for all stages: a null text counts as empty (its score is the classifier's intercept; it
equals other empty texts; it holds no benchmark item; it is packed as its end token); rows of a null
``doc_id`` are never near duplicates, and lose against any id among equal texts; rows that repeat
id and text become one in exact dedup; of groups of near duplicates the smallest id stays; with no labels
or no benchmark items nothing is toxic or contaminated; an empty table stays empty; columns beside the
known ones pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarryline.llm import decontamination, exact_dedup, packing, simhash, toxicity
from quarryline.llm.queries import tokenizer_path
from quarryline.llm.shared import cut


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what scores 0.5 or more; the classifier learns from the labels outside the held-out fold."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each text, that of the largest doc_id."""
    return exact_dedup.keep_one(docs)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group that fingerprints or shared five-word shingles (0.8 or more) link."""
    return simhash.keep_one(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what holds a benchmark item: 0.8 or more of its five-word shingles."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the rest into sequences of 2048 tokens; a row a piece."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", _toxicity),
    ("exact_dedup", _exact_dedup),
    ("near_dedup", _near_dedup),
    ("decontamination", _decontamination),
    ("packing", _packing),
]

#: The toxicity model and the token ids have no SQL form; a test holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
