"""The corpus pipeline: quality classifier, exact dedup, near-dedup, mixing, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which ``run`` writes as Parquet in the shared folder and reads back
as the next stage's ``docs``. Every stage works on all rows its predecessor kept. All but
the last return the columns of their input; an empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import exact_dedup, minhash, mixing, packing, quality_fm
from rivulet.llm.common import documents, stored
from rivulet.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    return quality_fm.kept(docs, read_table(spark, sf_dir, "labels"), meta=quality_fm.META)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the smallest id."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicate texts, the one with the smallest id."""
    return minhash.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to meet the target weights, repeated once per epoch that takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full token sequences in the proportions of the mixed sources."""
    return packing.pack(docs)


STAGES = [("quality_classifier", quality), ("exact_dedup", exact), ("near_dedup", near),
          ("mixing", mix), ("packing", pack)]

#: SQL can express neither the classifier, the sketches nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
