"""From raw documents to packed training sequences: quality rules, toxicity, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return the
columns of documents. An empty table gives an empty result at every stage; repeated rows are rows of their own up to
the near-duplicates, where one stays; texts are read whole, however long; columns beside those of documents are
dropped, whatever their names.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusengine.llm import packing, rules, secrets, simhash, toxicity
from corpusengine.llm._common import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; null, empty and blank texts fail the base test and go too."""
    return rules.keep(docs).select(*COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go (a score of exactly the threshold is toxic); without labels nothing goes. Null texts are scored as empty ones."""
    return toxicity.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component one row stays: that of the smallest doc_id (null last), ties by the smallest hash of the row. Null and blank texts are one component."""
    return simhash.single(docs.select(*COLUMNS))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its secrets replaced by the name of their kind; a null text stays null."""
    return secrets.redact(docs).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens: a row for each piece of each document; a null text is empty and is its end token alone."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("secrets", secret_scan), ("packing", best_fit_packing)]

#: Expectation-maximisation, a trained network and tokenizers: not for SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage by stage through Parquet in the shared folder; what a stage read is deleted when its own result is written."""
    shared_folder(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    out, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        stage(spark, out, sf_dir).write.parquet(f"{folder}/{name}")
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = f"{folder}/{name}"
        out = spark.read.parquet(before)
    return STAGES[-1][1](spark, out, sf_dir)
