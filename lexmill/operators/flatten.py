"""The ten flat tables of a nested record table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.citations import affecting_laws_table, modified_laws_table
from lexmill.schema import EXPORT_COLUMNS, RECORD_FIELDS


NEEDED = {"bill_text": "bill_text", "law_text": "law_text", "impact_assessments": "ia_text_url"}  # rows without it are left out


def project(df: DataFrame, columns: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """Fixed column list; a column the table lacks becomes NULL."""
    types = types or {}
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string")).alias(c)
                       for c in columns])


def unnest(records: DataFrame, array: str, columns: list[str]) -> DataFrame:
    """One row per array item with the record id; records with an empty or NULL array give none."""
    return project(records.select("record_id", F.inline(array)), columns)


def _not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def _amendments(records: DataFrame) -> DataFrame:
    flat = unnest(records, "amendments", EXPORT_COLUMNS["amendments"])
    names: Column = F.array_join("amendment_originator", "; ")
    return flat.withColumn("amendment_originator", names)


def export_table(records: DataFrame, table: str) -> DataFrame:
    columns = EXPORT_COLUMNS[table]
    if table in ("originators", "committees", "legislative_stages"):
        return unnest(records, table, columns)
    if table == "amendments":
        return _amendments(records)
    if table == "modified_laws":
        return modified_laws_table(records)
    if table == "affecting_laws":
        return affecting_laws_table(records)
    flat = project(records, columns, RECORD_FIELDS)
    needed = NEEDED.get(table)
    return _not_null(flat, needed) if needed else flat


NESTED = ["originators", "committees", "legislative_stages", "amendments"]
NARROW = {"record_id": "string", "law_id": "string", "date_passing": "string", "modified_laws": "array<string>"}


def record_lines(records: DataFrame, tables: list[str], options: dict[str, str]) -> DataFrame:
    """(table, no, value): the CSV lines of all tables that a record holds by itself, from one scan. Per partition `no` 0 is a header
    for each table. Beside them, as table `_narrow`, what citations need of a record, as JSON."""
    full = project(records, [c for c in RECORD_FIELDS], RECORD_FIELDS)

    def tagged(table: str) -> Column:
        columns = EXPORT_COLUMNS[table]

        def item_line(item: Column) -> Column:
            values = [(F.array_join(item[c], "; ") if c == "amendment_originator" else item[c]).alias(c) for c in columns[1:]]
            return F.to_csv(F.struct("record_id", *values), options)

        if table in NESTED:
            lines = F.transform(table, item_line)
        else:
            lines = F.array(F.to_csv(F.struct(*columns), options))
            needed = NEEDED.get(table)
            lines = F.when(F.col(needed).isNotNull(), lines) if needed else lines
        return F.transform(lines, lambda x: F.struct(F.lit(table).alias("table"), F.lit(1).alias("no"), x.alias("value")))

    parts = [tagged(t) for t in tables if t not in ("modified_laws", "affecting_laws")]
    cited = F.to_json(F.struct(*NARROW))
    parts.append(F.when(F.col("law_id").isNotNull() | (F.size("modified_laws") > 0), F.array(
        F.struct(F.lit("_narrow").alias("table"), F.lit(1).alias("no"), cited.alias("value")))))
    heads = header_lines(tables)
    empty = F.filter(heads, lambda _: F.lit(False))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    every = F.concat(F.when(first, heads).otherwise(empty), *[F.coalesce(p, empty) for p in parts])
    return full.select(F.inline(every))


def header_lines(tables: list[str]) -> Column:
    return F.array(*[F.struct(F.lit(t).alias("table"), F.lit(0).alias("no"), F.lit(",".join(EXPORT_COLUMNS[t])).alias("value"))
                     for t in tables])
