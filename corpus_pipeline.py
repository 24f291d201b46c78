"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage's result is written as Parquet below the shared folder and read again
as the next one's documents, so a lost executor costs a stage's tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainflow.llm import common
from chainflow.llm.stages import STAGES

#: The classifier and the tokenizer can't be stated in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = common.read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = common.written(stage(spark, docs, sf_dir), f"stage{i + 1}")
    return docs


__all__ = ["ORACLE_SQL", "STAGES", "run"]
