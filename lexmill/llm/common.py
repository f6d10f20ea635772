"""Helpers of the training-data operators: scratch tables, distributed numbering, components, block pairs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.session import materialise, new_path

SPACES = "\t\n\x0b\f\r "  # the white space that separates words: code points 9 to 13 and 32
FEW = 50_000  # rows of a small table that may be broadcast, once counted


def scratch(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends here, lost executors lose nothing."""
    return materialise(df, name)


def bucketed(rows: DataFrame, column: str, name: str) -> DataFrame:
    """`rows` as a table in the shared folder, bucketed by `column` as they lie, without a shuffle: grouping by the column later
    finds each group's rows in one file's place. Fit for columns of which a task has few values."""
    spark = rows.sparkSession
    table, path = f"{name}_{uuid.uuid4().hex}", new_path(spark, name)
    rows.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(partitions(spark), column).saveAsTable(table)
    return spark.table(table)


def aside(docs: DataFrame, used: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(`docs` with the columns that are not in `used` named by position, what gives a result all columns of `docs` under their names
    again). So an operator's own columns meet no others, whatever those are called."""
    inner = [c if c in used else f"_c{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*inner), lambda out: out.select(*[F.col(i).alias(c) for i, c in zip(inner, docs.columns, strict=True)])


def few(table: DataFrame) -> DataFrame:
    """A written table, to be broadcast where its rows are counted to be few; Spark chooses beyond."""
    return F.broadcast(table) if table.count() <= FEW else table


def chunk_of(row: str, size: int) -> Column:
    """Number of the chunk of `size` rows that a row of monotonically increasing id `row` is in; chunks don't cross partitions."""
    within = F.col(row).bitwiseAND(F.lit((1 << 33) - 1))
    return (F.shiftright(row, 33) * (1 << 33) + F.floor(within / size)).cast("long")


def drop_scratch(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a scratch table that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """Rows numbered from 0 in `order`, without one task seeing all of them: a range sort, then offsets from the counts of
    its partitions (one row per partition). Rows that are equal in `order` get any order among themselves."""
    spark = df.sparkSession
    placed = df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    placed = scratch(placed.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + within).drop("_part", "_before", "_at"))


def numbered_within(df: DataFrame, group: str, order: list, name: str = "rank") -> DataFrame:
    """Rows numbered from 0 within each `group` in `order`, rows that are equal there in the order they come. The sort is by ranges of
    group and order together, so a group of any size is spread over tasks. Offsets have a row per group and partition it is in; they are
    broadcast where they are counted to be few."""
    spark = df.sparkSession
    df = df.withColumn("_come", F.monotonically_increasing_id())
    placed = df.repartitionByRange(partitions(spark), group, *order, "_come").sortWithinPartitions(group, *order, "_come")
    placed = scratch(placed.drop("_come").withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(group, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_least"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least")).alias("_shift"))
    return (placed.withColumn("_part", part).join(few(scratch(offsets, "offsets")), [group, "_part"])
            .withColumn(name, F.col("_at") + F.col("_shift")).drop("_part", "_shift", "_at"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for each node of `edges` (a, b): component is the smallest node reachable.

    Large-star and small-star steps alternate until nothing changes, in O(log^2) rounds. Each step is a minimum per node,
    combined before the shuffle, and a join on the node between two written tables, so that adaptive execution can split a
    node with very many neighbours. Each round ends in the shared folder.
    """
    edge = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edge, last = scratch(edge, name), None
    while True:
        size = edge.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if size == last or not size[0]:
            break
        last = size
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch(large, name)
        low = scratch(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edge = scratch(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), name)
    leaves = edge.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return leaves.unionByName(edge.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def block_pairs(rows: DataFrame, group: str, size: str, item: str, block: int) -> DataFrame:
    """Copies of `rows` such that every pair of a group meets in just one (group, b1, b2), each at most 2 * `block` rows.

    `size` is the column with the group's number of rows. A group is cut into ceil(size / block) blocks by a hash of `item`; a row of
    block x goes to every pair of blocks that has x, as `own` for the first of the pair. Pairs of blocks are tasks of their own.
    """
    n = F.ceil(F.col(size) / block).cast("int")
    placed = rows.withColumn("_x", F.pmod(F.xxhash64(item, F.lit(7)), n).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda y: F.struct(
        F.least("_x", y).alias("b1"), F.greatest(F.col("_x"), y).alias("b2")))
    placed = placed.withColumn("_pair", F.explode(pairs))
    return placed.select(*[c for c in rows.columns if c != size], F.col("_pair.b1").alias("b1"), F.col("_pair.b2").alias("b2"),
                         (F.col("_x") == F.col("_pair.b1")).alias("own"))


def whole_groups(batches, keys: list[str]):
    """(table, bounds): Arrow tables of whole groups from record batches sorted by `keys`; group i is rows bounds[i] to
    bounds[i + 1]. Holds one batch and the group that goes on in the next."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows, bool)
        for k in keys:
            values = table.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(change)
        last = int(starts[-1]) if len(starts) else 0
        if last:
            yield table.slice(0, last), [0, *starts.tolist()]
        rest = table.slice(last)
    if rest is not None and rest.num_rows:
        yield rest, [0, rest.num_rows]


def stars(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix: the first row that each row is connected with."""
    n = len(linked)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] < 0:
            group, new = np.zeros(n, bool), np.zeros(n, bool)
            new[i] = True
            while new.any():
                group |= new
                new = linked[new].any(0) & ~group
            root[group] = i
    return root
