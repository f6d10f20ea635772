"""Snapshots kept in buckets of their key, so that a change rewrites the buckets it touches and nothing else.

Rows lie in one folder per bucket of the key's hash. A change reads the touched buckets (the scan is pruned to their folders) and overwrites
them; the others are not opened. Each stored row carries the batch that last wrote its bucket, and a bucket without rows keeps
one with a NULL key that says so: a batch that is run again, in whole or in part, passes over the buckets it has written. So changes that are
relative, as counts by difference are, may be repeated after a failure too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.keyed import fuse, patch
from lexmill.session import materialise


class Buckets:
    """Table `columns` (name -> type) in `folder`, in `count` buckets of `key`, each written by `files` tasks."""

    def __init__(self, spark: SparkSession, folder: str, key: str, columns: dict[str, str], count: int = 64, files: int = 1):
        self.spark, self.folder, self.key, self.columns, self.count, self.files = spark, folder, key, columns, count, files

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.count)).cast("int")

    def _stored(self) -> DataFrame:
        schema = ", ".join(f"`{c}` {t}" for c, t in self.columns.items())
        return self.spark.read.schema(f"{schema}, _batch string, _bucket int").parquet(self.folder)

    def create(self, rows: DataFrame, batch: str = "first") -> Buckets:
        """Writes all buckets, empty ones with their mark."""
        self._write(rows.select(*self.columns).withColumn("_bucket", self.bucket()), list(range(self.count)), batch)
        return self

    def read(self) -> DataFrame:
        return self._stored().where(F.col(self.key).isNotNull()).select(*self.columns)

    def _write(self, rows: DataFrame, buckets: list[int], batch: str) -> None:
        marks = self.spark.createDataFrame([(b,) for b in buckets], "_bucket int").select(
            *[F.lit(None).cast(t).alias(c) for c, t in self.columns.items()], "_bucket")
        part = F.pmod(F.xxhash64(self.key, F.lit(1)), F.lit(self.files))
        out = rows.unionByName(marks).withColumn("_batch", F.lit(batch)).repartition(len(buckets) * self.files, "_bucket", part)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.folder)

    def change(self, keys: DataFrame, batch: str, make: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Overwrites the buckets that hold any of `keys` by `make` of their rows, and returns which. `make` must leave all rows in place whose
        keys are not among `keys`. At most as many numbers as there are buckets reach the driver."""
        touched = sorted(r[0] for r in keys.where(F.col(self.key).isNotNull()).select(self.bucket()).distinct().collect())
        stored = self._stored().where(F.col("_bucket").isin(touched))
        done = {r[0] for r in stored.where(F.col("_batch") == batch).select("_bucket").distinct().collect()} if touched else set()
        due = [b for b in touched if b not in done]
        if due:
            rows = stored.where(F.col("_bucket").isin(due) & F.col(self.key).isNotNull()).select(*self.columns)
            made = make(rows).select(*self.columns).withColumn("_bucket", self.bucket()).where(F.col("_bucket").isin(due))
            self._write(materialise(made, "buckets"), due, batch)
        return due

    def patch(self, batch: str, changes: list[tuple[DataFrame, list[str]]], deleted: DataFrame | None = None, new: DataFrame | None = None) -> list[int]:
        """One pass for several patches, deletes (keys) and new rows; a later patch of the same column wins."""
        fused, columns = fuse(changes, self.key)
        fused = materialise(fused, "changes")
        keys = [fused.select(self.key), *[x.select(self.key) for x in (deleted, new) if x is not None]]
        every = keys[0]
        for k in keys[1:]:
            every = every.unionByName(k)

        def make(rows: DataFrame) -> DataFrame:
            rows = patch(rows, fused, self.key, columns, hits=True)
            rows = rows if deleted is None else rows.join(deleted.select(self.key).distinct(), self.key, "left_anti")
            return rows if new is None else rows.unionByName(new.select(*self.columns))

        return self.change(materialise(every, "keys"), batch, make)
