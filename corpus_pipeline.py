"""From raw documents to token files: five stages, each written and read again before the next.

STAGES lists (name, function); a function takes (spark, docs, sf_dir), docs being all rows that
the stage before it kept, and returns a DataFrame. All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import copies, decontaminate, mixing, tokens, toxicity
from tidemark.llm._common import table
from tidemark.session import scratch_path


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the class-conditional models, trained on all labels, do not predict to be toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.keep_clean(docs, model)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest doc_id.

    Near duplicates agree in 0.8 or more of their five-word shingles. Pairs come from SimHash with
    pigeonring filtering and, since many are beyond its three bits, from banded minimum hashes; all are
    checked on whole shingle sets.
    """
    return copies.keep_one(docs)


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without an item of the benchmark."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs, table(spark, sf_dir, "labels"))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, and one row for each text read back from them."""
    path = scratch_path(spark, "token-files")
    tokens.write_token_files(docs, path)
    return tokens.read_token_files(spark, path, ids=False).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "segment")


STAGES = [
    ("toxicity", toxic_out),
    ("near duplicates", near_copies_out),
    ("benchmark decontamination", leaks_out),
    ("source mix", mix),
    ("token files", token_files),
]

#: SQL has no counterpart for the trained models and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
