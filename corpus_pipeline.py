"""Corpus pipeline: five stages over documents, each written as Parquet and read again for the next one.

Every stage takes all that its predecessor kept, and returns the columns of documents but for the last, which returns the
places of the token pieces. Stages: toxic documents go; one document of each group of near copies stays; personal data is replaced by
its kind; sources are mixed to their target weights (whole rounds of a document are copies, a part is a row of its own); all that
is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import mixing, near_text, packing, pii, toxicity
from lexmill.llm.common import scratch
from lexmill.llm.queries import table, tokenizer_path

ORACLE_SQL = None  # classifiers and MinHash are not SQL; the tests hold each stage against brute force


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_text.without_near_duplicates(docs)


def scrub_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.scrubbed(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [("drop_toxic", drop_toxic), ("drop_near_duplicates", drop_near_duplicates),
          ("scrub_personal_data", scrub_personal_data), ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return docs
