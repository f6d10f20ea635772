"""The cache of document texts, stored by cleaned URL so that look-ups come to the texts.

Texts are the heaviest column there is. `TextCache.write` brings them into one row per cleaned URL once, in buckets of that URL; from then on a look-up
shuffles its URLs to the buckets, and the texts stay where they are written, however many look-ups there are.
The files and their buckets outlast the session; `open` makes them known to another one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.urls import clean_url
from lexmill.operators.keyed import pick_one
from lexmill.session import new_path


def one_per_clean_url(doc_texts: DataFrame) -> DataFrame:
    """(clean_url, extracted_text): the smallest url of each cleaned one; empty texts count as missing."""
    texts = doc_texts.select(clean_url("url").alias("clean_url"), F.col("url").alias("_url"),
                             F.nullif("extracted_text", F.lit("")).alias("extracted_text"))
    return pick_one(texts, "clean_url", "_url", ["extracted_text"])


@dataclass
class TextCache:
    spark: SparkSession
    name: str
    path: str

    @staticmethod
    def write(doc_texts: DataFrame, buckets: int | None = None, path: str | None = None) -> TextCache:
        """Stores a text table; `buckets` should let one bucket's texts fit in a task many times over."""
        spark = doc_texts.sparkSession
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        cache = TextCache(spark, f"text_cache_{uuid.uuid4().hex}", path or new_path(spark, "text_cache"))
        # One task writes a bucket, so a bucket is one sorted file.
        (one_per_clean_url(doc_texts).repartition(n, "clean_url").write.format("parquet").option("path", cache.path)
         .bucketBy(n, "clean_url").sortBy("clean_url").saveAsTable(cache.name))
        return cache

    @staticmethod
    def open(spark: SparkSession, path: str, buckets: int) -> TextCache:
        cache = TextCache(spark, f"text_cache_{uuid.uuid4().hex}", path)
        spark.sql(f"CREATE TABLE {cache.name} (clean_url STRING, extracted_text STRING) USING parquet CLUSTERED BY (clean_url) "
                  f"SORTED BY (clean_url) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
        return cache

    def texts(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Takes the table out of the catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
