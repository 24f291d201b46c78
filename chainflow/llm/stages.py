"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

``docs`` is what the stage before has kept.  Every stage but the last returns the
columns of ``documents``; where a stage changes a text, its n_chars follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import decontaminate, jaccard_join, packing, quality, secrets


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = C.read(spark, sf_dir, "labels")
    return quality.keep_good(docs, quality.train(docs, labels))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return jaccard_join.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.decontaminate(docs, C.read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    clean = secrets.redact(docs.withColumn("_before", F.length("text")), C.scratch(spark, "ledger"))
    if "n_chars" not in docs.columns:
        return clean.select(*docs.columns)
    changed = ~F.length("text").eqNullSafe(F.col("_before"))
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
                            ).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents, packed into sequences."""
    return packing.pack(docs).drop("ids")


STAGES = [
    ("quality classifier", keep_good_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack_sequences),
]
