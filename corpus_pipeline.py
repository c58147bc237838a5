"""The training-data pipeline: quality rules, quality classifier, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of `documents`. `run` writes each result as Parquet in the shared folder and reads it again.
SQL can express neither the fitted stages nor the sketches, so there is no ORACLE_SQL: the tests
hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm import minhash, nbsvm, outliers, packing, pii
from canopy.llm.common import table, written
from canopy.llm.queries import word_tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are no robust outlier of their language and source."""
    return outliers.keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good. It is fitted on the labelled rows of all
    `documents`, because the stage before has taken most bad examples out of `docs`."""
    model = nbsvm.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return nbsvm.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked; n_chars follows."""
    return pii.redact(docs, text_length="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, packed into sequences of 2048."""
    return packing.pack_documents(docs, word_tokenizer()).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("packing", packed),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
