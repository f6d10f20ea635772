"""Readers with explicit schemas; filters and column choice reach the parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import schema


def read_pages(spark: SparkSession, path: str, country: str | None = None) -> DataFrame:
    df = spark.read.schema(schema.PAGES).parquet(path)
    return df.where(F.col("country") == country) if country else df


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.RECORDS).parquet(path)


def read_doc_texts(spark: SparkSession, path: str, collection: str | None = None) -> DataFrame:
    df = spark.read.schema(schema.DOC_TEXTS).parquet(path)
    return df.where(F.col("collection") == collection) if collection else df


def read_table_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.TABLE_CELLS).parquet(path)


def read_members(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.MEMBERS).parquet(path)


WIDEST = 64  # columns an amendment file may have; a wider one is an error, not cut


def file_key(path: Column) -> Column:
    """One form for the ways to write a file's path: with or without `file:` and its slashes, escaped or plain."""
    known = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.regexp_replace(F.regexp_replace(known, "^file:/*", "/"), "^([a-z0-9]+):/+", "$1://")


def read_amendment_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Semicolon-separated amendment files, each row tagged with the id, URL and bill title of its file.

    `manifest(file_path, amendment_file_id, amendment_file_url, bill_title)` has one row per file. Every file is read by its own header: columns
    in any order, unknown ones left out, missing ones NULL. A file's header is its first row, found by a minimum that is combined
    before the shuffle; the headers, one row per file, are broadcast, so the rows stay where they are read.
    """
    columns = ", ".join(f"_c{i} string" for i in range(WIDEST + 1))
    cells = (spark.read.option("sep", ";").option("header", False).option("multiLine", True).option("escape", '"').schema(columns).csv(folder)
             .select(F.array(*[F.col(f"_c{i}") for i in range(WIDEST + 1)]).alias("cells"), F.col("_metadata.file_path").alias("path")))
    numbered = cells.withColumn("_row", F.monotonically_increasing_id())  # a file is read by one task, from its start
    # All rows have the widest length, filled up with NULL; only the few headers are cut to their own.
    width = F.coalesce(F.array_max(F.transform("head", lambda c, i: F.when(c.isNotNull(), i + 1))), F.lit(0))
    names = F.transform(F.slice("head", F.lit(1), width), lambda c: F.trim(F.regexp_replace(c, "^\ufeff", "")))
    headers = numbered.groupBy("path").agg(F.min_by("cells", "_row").alias("head")).select("path", "head", names.alias("names"))
    wide = F.concat(F.lit(f"more than {WIDEST} columns in "), "path")
    headers = headers.withColumn("names", F.when(F.size("names") > WIDEST, F.raise_error(wide)).otherwise(F.col("names")))
    known = manifest.withColumn("_key", file_key(F.col("file_path"))).drop("file_path")
    headers = headers.withColumn("_key", file_key(F.col("path"))).join(known, "_key").drop("_key")
    rows = cells.join(F.broadcast(headers), "path").where(~F.col("cells").eqNullSafe(F.col("head")))

    def value(name: str) -> Column:
        place = F.array_position("names", F.lit(name))
        return F.when(place > 0, F.get("cells", (place - 1).cast("int"))).alias(name)

    return rows.select(*map(value, schema.AMENDMENT_FILE_COLUMNS), *[c for c in known.columns if c != "_key"])
