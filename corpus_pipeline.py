"""The training-data pipeline: five operators in a row over the documents.

Every stage gets what its predecessor kept as a written table, and all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoutline.llm import decontamination, packing, passages, quality_classifier, simhash
from scoutline.llm.queries import sequence_length, table
from scoutline.session import stored


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; all of them if there is nothing to learn from."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    if not model.rows:
        return docs
    score = quality_classifier.scorer(spark, model)
    return docs.filter(score(F.col("text")) >= model.settings.keep)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=3, k=3)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of smaller id has."""
    return passages.without_passages(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in the training sequences."""
    return packing.pack_documents(docs, sequence_length(F.col("text")))


STAGES = (
    ("quality classifier", classify),
    ("SimHash near-dedup", deduplicate),
    ("substring dedup", cut_passages),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
)

#: No SQL can train the classifier or pack bins; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before it is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    *earlier, (_, last) = STAGES
    for name, stage in earlier:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
