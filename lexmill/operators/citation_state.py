"""Citation counts kept up to date by differences, deletes and new dates included.

The state has one row per cited law and passing date with the number of citing records, and one per law and record that holds it. A batch says
how changed records were and how they are now; its difference (citations now less citations before) is added, and rows that reach zero go. Counts
are sums of the state; the earliest date is the least one left, so when the record that had it is deleted or dated anew the next
one follows. A law cited by a third of all records has as many rows as it has dates, not as many as citations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.dates import iso, parse_any
from lexmill.operators.citations import edges
from lexmill.sources.buckets import Buckets

COLUMNS = {"law_id": "string", "kind": "string", "day": "date", "record_id": "string", "n": "bigint"}
ROW = ["law_id", "kind", "day", "record_id"]


def facts(records: DataFrame, sign: int = 1) -> DataFrame:
    """Rows of the state that records make (`cited`: one per law and date, `held`: one per law and holder), times `sign`."""
    cited = edges(records).select("law_id", F.lit("cited").alias("kind"), parse_any("date_passing").cast("date").alias("day"),
                                  F.lit(None).cast("string").alias("record_id"))
    held = records.where("law_id is not null").select("law_id", F.lit("held").alias("kind"), F.lit(None).cast("date").alias("day"), "record_id")
    return cited.where("law_id is not null").unionByName(held).groupBy(*ROW).agg(F.count(F.lit(1)).alias("n")).withColumn("n", F.col("n") * sign)


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a batch adds: `before` and `after` are the changed records alone, deleted ones in the first, new ones in the second."""
    both = facts(before, -1).unionByName(facts(after))
    return both.groupBy(*ROW).agg(F.sum("n").alias("n")).where("n <> 0")


def add(state: DataFrame, more: DataFrame) -> DataFrame:
    return state.unionByName(more).groupBy(*ROW).agg(F.sum("n").alias("n")).where("n <> 0")


def counts(state: DataFrame) -> DataFrame:
    return state.where("kind = 'cited'").groupBy("law_id").agg(F.sum("n").alias("count"))


def rollup(state: DataFrame) -> DataFrame:
    """Per cited law: number of citing records and their earliest valid passing date."""
    return state.where("kind = 'cited'").groupBy("law_id").agg(
        F.sum("n").alias("affecting_laws_count"), iso(F.min("day")).alias("affecting_laws_first_date"))


def owned_rollup(state: DataFrame) -> DataFrame:
    """Rollup keyed by the record that owns the cited law, the one with the smallest id."""
    own = state.where("kind = 'held'").groupBy("law_id").agg(F.min("record_id").alias("record_id"))
    return rollup(state).join(own, "law_id").select("record_id", "law_id", "affecting_laws_count", "affecting_laws_first_date")


def store(records: DataFrame, folder: str, count: int = 64) -> Buckets:
    """The state in buckets of the law."""
    return Buckets(records.sparkSession, folder, "law_id", COLUMNS, count).create(facts(records))


def advance(stored: Buckets, before: DataFrame, after: DataFrame, batch: str) -> list[int]:
    """Adds a batch to a stored state, in the buckets of its laws alone. The same batch again changes nothing."""
    more = difference(before, after)
    return stored.change(more, batch, lambda rows: add(rows, more))
