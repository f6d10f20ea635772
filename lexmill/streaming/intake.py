"""Resumable intake of new pages as a stream over the page folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexmill import schema
from lexmill.operators.idrange import IdRanges, high_water
from lexmill.operators.keyed import keep_first, unseen
from lexmill.session import materialise


def intake(spark: SparkSession, pages_path: str, records_path: str, checkpoint: str,
           extract: Callable[[DataFrame, int], DataFrame], record_schema: str, prefix: str = "PT") -> StreamingQuery:
    """Extracts records from pages whose URL is not stored yet and appends them; ends when all pages are read.

    Each batch drops repeated URLs and the URLs of earlier batches, so a rerun of a batch adds nothing. `extract` gets
    the new pages and the number from which record ids continue: a range is reserved for each batch, beside the checkpoint.
    """
    ids = IdRanges(spark, f"{checkpoint.rstrip('/')}-ids")

    def store(batch: DataFrame, number: int) -> None:
        stored = batch.sparkSession.read.schema(record_schema).parquet(records_path)
        new = unseen(batch, stored.select(F.col("bill_page_url").alias("url")), "url")
        one = keep_first(new.withColumn("_id", F.sha2(F.concat_ws("\x00", "url", "kind", "html"), 256)).dropDuplicates(
            ["_id"]), ["url", "kind"], "_id").drop("_id")
        one = materialise(one, "pages")
        first = ids.reserve(prefix, str(number), one.count(), high_water(stored, prefix))
        extract(one, first - 1).write.mode("append").parquet(records_path)

    spark.createDataFrame([], record_schema).write.mode("append").parquet(records_path)
    pages = spark.readStream.schema(schema.PAGES).parquet(pages_path)
    return (pages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
