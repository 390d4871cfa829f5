"""Corpus pipeline: the stages in order, each over all rows that the one
before it kept, written as a table in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from occurrence_lake.llm import bpe_stream, decontaminate, quality, simhash
from occurrence_lake.llm.common import table, written
from occurrence_lake.llm.queries import tokenizer_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.  It is fitted on the
    weak labels of its own input."""
    return quality.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs, shingle_words=3, radius=3)


def decontaminate_docs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages (by the contract's share)."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding of every document that is left."""
    return bpe_stream.bpe_digests(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", classify),
    ("simhash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate_docs),
    ("bpe encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "pipeline-" + name.replace(" ", "-"))
    return docs


#: Fingerprints, encodings and the fitted classifier are beyond SQL; the
#: tests hold the stages against brute-force versions.
ORACLE_SQL = None
