"""Corpus pipeline: quality, near-duplicates, secrets, mixture and packing, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next one's ``docs``; all but the last return the
columns of ``documents``. Stages are judged on their own input: models, groups
and source sizes are those of the rows that the stages before kept.

Edge cases: an empty input passes every stage as an empty frame; null and empty
texts score the classifier's intercept, share fingerprint zero (one of them
stays), hold no secrets, are taken with no words and so leave at the mixing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.llm import common, mixing, nbsvm, packing, secrets_cnn, simhash_golay


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return nbsvm.accepted(docs, nbsvm.train(docs, common.table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash_golay.representatives(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return _measured(secrets_cnn.redacted(docs, secrets_cnn.train(docs)))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole and fractional repetitions that bring every source to its target."""
    return _measured(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-duplicates", near_duplicates),
    ("secret scans", secrets),
    ("mixing to target weights", mixture),
    ("packing", packed),
]

#: Trained models, XXH64 and byte-pair merges have no SQL form; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the packed sequences."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir))
    return docs
