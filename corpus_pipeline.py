"""The corpus pipeline: from raw documents to an interleaved training order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages
the rows are written as Parquet and read again, so a stage starts from files.
All but the last return the columns of documents. Stages handle nulls, empty
tables, repeated rows and further columns as their operators state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from episodica.llm import decontam, mixing, ngram_join, pii, toxicity
from episodica.llm.common import shared_folder


def detoxify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark's passages go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in texts; n_chars follows."""
    return pii.scrub(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its slot in the mixture; files follow the order of slots."""
    return mixing.interleave(docs).repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")


STAGES = [("toxicity", detoxify), ("near_duplicates", deduplicate), ("decontamination", decontaminate), ("personal_data", redact), ("mixing", mix)]

#: The classifier of the first stage can't be expressed in SQL.
ORACLE_SQL = None


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written to the shared folder and read again.

    A stage's rows are removed once the next stage's are written; those of the
    last but one stay, since the result reads them.
    """
    base, before = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            at = f"{base}-{k}-{name}"
            docs.write.parquet(at)
            docs = spark.read.parquet(at)
            if before:
                _remove(spark, before)
            before = at
    return docs
