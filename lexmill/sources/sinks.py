"""Sinks: record snapshots and the flat export."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.citations import affecting_laws_table, modified_laws_table
from lexmill.operators.flatten import NARROW, header_lines, record_lines
from lexmill.schema import EXPORT_COLUMNS

READ_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true"}
# Without the two switches the writer would trim the values.
WRITE_OPTIONS = {"header": "true", "escape": '"', "emptyValue": '""', "ignoreLeadingWhiteSpace": "false",
                 "ignoreTrailingWhiteSpace": "false"}


def append_records(records: DataFrame, path: str) -> None:
    records.write.mode("append").partitionBy("country").parquet(path)


def write_table(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def read_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.options(**READ_OPTIONS).schema(schema).csv(path)


def export(records: DataFrame, folder: str, country: str, day: str, tables: list[str] | None = None) -> dict[str, str]:
    """Writes the flat tables as CSV with a header under folder/country/day/table, all or none.

    One scan of the records: each gives its lines for all tables, which one job writes below one folder per table, and the few columns
    that citations need, from which the last two tables are made. All of it lies in a staging folder that takes its place by one rename; what
    was there before goes last. A failed export leaves no part of a day.
    """
    spark, tables = records.sparkSession, tables or list(EXPORT_COLUMNS)
    own = records.where(F.col("country") == country) if "country" in records.columns else records
    staged, final = f"{folder}/{country}/.{day}-{uuid.uuid4().hex}", f"{folder}/{country}/{day}"
    heads = spark.range(1).select(F.inline(header_lines(tables)))  # so that a table without rows has its header too
    lines = record_lines(own, tables, WRITE_OPTIONS).unionByName(heads)
    # A task writes a table's lines in this order, so each file begins with a header.
    lines.sortWithinPartitions("table", "no").select("table", "value").write.partitionBy("table").text(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    for table, make in (("modified_laws", modified_laws_table), ("affecting_laws", affecting_laws_table)):
        if table in tables:
            narrow = f"{staged}/table=_narrow"
            cited = ", ".join(f"{c} {t}" for c, t in NARROW.items())
            facts = spark.read.schema(cited).json(narrow) if fs.exists(path(narrow)) else spark.createDataFrame([], cited)
            write_table(make(facts), f"{staged}/table={table}")
    fs.delete(path(f"{staged}/table=_narrow"), True)
    for table in tables:
        fs.rename(path(f"{staged}/table={table}"), path(f"{staged}/{table}"))
    before = f"{staged}-before"
    replaced = fs.exists(path(final)) and fs.rename(path(final), path(before))
    if not fs.rename(path(staged), path(final)):
        raise OSError(f"cannot move {staged} to {final}")
    if replaced:
        fs.delete(path(before), True)
    return {table: f"{final}/{table}" for table in tables}
