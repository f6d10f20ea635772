"""Operators on keyed tables: first of each key, resume, patch, merge, numbering.

Keys are never assumed unique or evenly spread. Groups are reduced with map-side combining and never gathered whole;
`find any` lookups take the smallest id, so results do not depend on the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_first(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """One row per key, the one with the smallest `order` (a unique id).

    The minimum per key is combined before the shuffle and the rows are picked by their id, so a key holding a third
    of the table costs nothing extra; a row_number window would put all its rows into one task.
    """
    keys = [key] if isinstance(key, str) else key
    firsts = df.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
    return df.join(firsts, order, "left_semi")


def pick_one(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Lookup table with one row per non-null key, taken from the row with the smallest `order`."""
    row = F.min_by(F.struct(*columns), order).alias("row")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(row).select(key, "row.*")


def duplicated(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def unseen(found: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet."""
    return found.join(stored.select(key), key, "left_anti")


def work_list(df: DataFrame, have: str, missing: str) -> DataFrame:
    return df.where(F.col(have).isNotNull() & F.col(missing).isNull())


def patch(df: DataFrame, changes: DataFrame, key: str, columns: list[str], hits: bool = False) -> DataFrame:
    """New snapshot with some columns of matching rows replaced; `changes` has one row per key.

    A change to NULL is a change, hence the hit marker instead of `coalesce`. With `hits`, `changes` says so for each column (`_hit_<column>`), as
    those of `fuse` do.
    """
    marks = [F.col(f"_hit_{c}") for c in columns] if hits else [F.lit(True).alias(f"_hit_{c}") for c in columns]
    marked = changes.select(key, *marks, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(marked, key, "left")
    out = [F.when(F.col(f"_hit_{c}"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
           for c in df.columns]
    added = [F.when(F.col(f"_hit_{c}"), F.col(f"_new_{c}")).alias(c) for c in columns if c not in df.columns]
    return joined.select(*out, *added)


def fuse(changes: list[tuple[DataFrame, list[str]]], key: str) -> tuple[DataFrame, list[str]]:
    """Several patches as one, for one join in place of one each: (a row per key with its changed columns and `_hit_<column>`, all columns).
    Patches must not read what others write; where two change a column of a row, the later one wins."""
    types = {}
    for df, columns in changes:
        types |= {c: df.schema[c].dataType for c in columns}
    columns, every = list(types), None
    for n, (df, own) in enumerate(changes):
        part = df.select(key, *[(F.struct(F.lit(n).alias("n"), F.col(c).cast(types[c]).alias("v")) if c in own else F.lit(None).cast(
            T.StructType([T.StructField("n", T.IntegerType(), False), T.StructField("v", types[c])]))).alias(c) for c in columns])
        every = part if every is None else every.unionByName(part)
    last = every.groupBy(key).agg(*[F.max_by(c, f"{c}.n").alias(c) for c in columns])
    return last.select(key, *[F.col(f"{c}.v").alias(c) for c in columns], *[F.col(c).isNotNull().alias(f"_hit_{c}") for c in columns]), columns


def patch_all(df: DataFrame, changes: list[tuple[DataFrame, list[str]]], key: str) -> DataFrame:
    """New snapshot after several patches, by one join."""
    fused, columns = fuse(changes, key)
    return patch(df, fused, key, columns, hits=True)


def patch_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Patch whose new values come from the row itself: no join."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in changes.items()})


def number_rows(df: DataFrame, url: str, digits: int = 3) -> DataFrame:
    """Adds `n`, numbering rows 1.. in the order of (md5(url), url); `url` must be unique.

    Rows fall into 16^digits equal buckets by the head of the hash; bucket sizes (that many rows at most, so the
    broadcast is bounded) give each bucket its offset, and only buckets are sorted. Unlike a global row_number no task
    sees more than one bucket, and unlike partition offsets the numbers are the same on every run.
    """
    hashed = df.withColumn("_md5", F.md5(F.col(url))).withColumn("_bucket", F.substring("_md5", 1, digits))
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_bucket").orderBy("_md5", url)
    return (hashed.join(F.broadcast(offsets), "_bucket")
            .withColumn("n", F.col("_before") + F.row_number().over(inside))
            .drop("_md5", "_bucket", "_before"))


def assign_record_ids(df: DataFrame, url: str, prefix: str, stored: int = 0) -> DataFrame:
    """Ids continuing after the number `stored`: prefix and at least five digits."""
    numbered = number_rows(df, url)
    return numbered.withColumn("record_id", F.format_string(prefix + "%05d", F.col("n") + stored)).drop("n")


def regroup(rows: DataFrame, key: str, position: str, item: Column, name: str) -> DataFrame:
    """Items exploded from one array per key back into that array, in order; as bounded as the array was."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), item.alias("v"))))
    return rows.groupBy(key).agg(F.transform(packed, lambda x: x.v).alias(name))
