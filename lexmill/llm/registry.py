"""Queries of the training-data operators and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
