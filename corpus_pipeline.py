"""A training-data pipeline over the documents: each stage is written and read again before the next.

Toxic documents go, one of each group of near-duplicates stays, documents that hold a benchmark item go, personal
data is masked, and the texts are encoded. The rows of the result are the documents that stay, with their token
ids (little-endian unsigned 32-bit integers) and their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlake.llm import decontam, neardup, pieces, pii, toxicity
from roadlake.llm.common import table
from roadlake.session import materialize

STAGES = [
    ("toxicity", toxicity.stage),
    ("jaccard_join", neardup.stage),
    ("decontamination", decontam.stage),
    ("pii", pii.stage),
    ("sentencepiece", pieces.stage),
]
#: A trained model, edit distances and a tokenizer are no SQL: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
