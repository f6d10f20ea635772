"""Which law modifies which: a directed graph kept as an edge table.

A law cited by a third of all records would make one unbounded array on its record, so the citing records stay rows;
counts and earliest dates are aggregated with map-side combining.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.dates import iso, parse_any
from lexmill.operators.keyed import patch, pick_one

def edges(records: DataFrame) -> DataFrame:
    """(record_id, date_passing, law_id): one row per cited law of a record."""
    return records.select("record_id", "date_passing", F.explode("modified_laws").alias("law_id"))


def citation_counts(records: DataFrame) -> DataFrame:
    return edges(records).groupBy("law_id").agg(F.count(F.lit(1)).alias("count"))


def citation_rollup(records: DataFrame) -> DataFrame:
    """Per cited law: number of citing records and their earliest valid passing date."""
    return edges(records).groupBy("law_id").agg(
        F.count(F.lit(1)).alias("affecting_laws_count"),
        iso(F.min(parse_any("date_passing"))).alias("affecting_laws_first_date"))


def law_owners(records: DataFrame) -> DataFrame:
    """law_id to the record that holds it; the smallest record id if several do."""
    return (records.where(F.col("law_id").isNotNull()).groupBy("law_id")
            .agg(F.min("record_id").alias("owner_record_id")))


def owned_rollup(records: DataFrame) -> DataFrame:
    """Rollup keyed by the record that owns the cited law."""
    return (citation_rollup(records).join(law_owners(records), "law_id")
            .select(F.col("owner_record_id").alias("record_id"), "law_id", "affecting_laws_count",
                    "affecting_laws_first_date"))


def citation_changes(records: DataFrame) -> tuple[DataFrame, list[str]]:
    """Both rollup columns of the owners of cited laws, as a patch."""
    return owned_rollup(records), ["affecting_laws_count", "affecting_laws_first_date"]


def with_citation_rollup(records: DataFrame) -> DataFrame:
    """Records with both rollup columns set on the owners of cited laws."""
    changes, columns = citation_changes(records)
    return patch(records, changes, "record_id", columns)


def affecting_edges(records: DataFrame) -> DataFrame:
    """(record_id, affecting_record_id): who modifies the law of a record.

    A law cited by very many is split by adaptive execution: the citing side reaches the join straight from its shuffle.
    """
    cited = edges(records).select("law_id", F.col("record_id").alias("affecting_record_id"))
    joined = cited.join(law_owners(records), "law_id")
    return joined.select(F.col("owner_record_id").alias("record_id"), "affecting_record_id")


def modified_laws_table(records: DataFrame) -> DataFrame:
    """Exported table: each cited law with the record owning it, NULL if none does."""
    joined = edges(records).join(law_owners(records), "law_id", "left")
    return joined.select("record_id", F.col("law_id").alias("modified_law_id"),
                         F.col("owner_record_id").alias("modified_record_id"))


def affecting_laws_table(records: DataFrame) -> DataFrame:
    """Exported table: each affecting record with its own law id."""
    ids = pick_one(records.select(F.col("record_id").alias("affecting_record_id"),
                                  F.col("law_id").alias("affecting_law_id")),
                   "affecting_record_id", "affecting_law_id", ["affecting_law_id"])
    return (affecting_edges(records).join(ids, "affecting_record_id", "left")
            .select("record_id", "affecting_law_id", "affecting_record_id"))
