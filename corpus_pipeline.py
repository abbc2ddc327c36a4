"""The corpus pipeline: quality, near-duplicates, decontamination, mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. run() writes the result of
each stage as Parquet in the shared folder and reads it again for the next one.

Defined results. Rows with null or empty texts pass or go as their operators say (see pairloom.llm): the classifier scores an empty text as any
other, empty texts are copies of each other, they hit no benchmark, the mix never takes a document without words, and an empty
table stays empty through all stages. Further columns of documents are carried through. The mix may return a row up to
three times; those rows have the same doc_id, and the last stage writes each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairloom.llm import decontaminate, mixing, quality_model, simhash, tokens
from pairloom.llm.common import stash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of documents outside the held-out fold."""
    model = quality_model.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.accept(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group that SimHash links reach."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens and ids_crc32 of each row."""
    return tokens.write_and_read(docs, tokens.tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mix),
    ("token ids", token_ids),
]

#: XXH64 fingerprints, learned rules and byte-pair ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, f"stage{k}")
    return docs
